"""Near duplicates among embeddings by cross-polytope hashing.

A vector is turned by pseudo-random rotations (sign flips and fast Hadamard
transforms, three rounds); its hash is the nearest vertex of the cross-polytope,
that is the largest coordinate and its sign. Two hashes make a bucket. With
multiprobe a vector goes to the likeliest `PROBES` buckets of each of `TABLES`
tables. Pairs that share a bucket are verified by their cosine in double
precision; a pair that shares several buckets counts in the first one only.

Equal vectors are one class with a count, so a hot vector is one row. Large
buckets are cut into cells; a task returns a count per vector and the edges
that join parts, never the pairs.

Nulls and edges: a vector that is null, empty, zero or holds null or
non-finite components links with nothing. Vectors of different length never
link. Rows with equal ids stay rows of their own; a null id is never a
component id while the component has another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.buckets import Forest, cells, runs
from ledgerlark.llm.components import connected_components
from ledgerlark.storage import write_stage

LEAST_COSINE = 0.9
TABLES = 5
PROBES = 3
HASHES = 2
_ROUNDS = 3
_BLOCK = 512
_SEED = 20


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of every row; the width is a power of two."""
    width, step = rows.shape[1], 1
    while step < width:
        pairs = rows.reshape(len(rows), -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        rows = rows.reshape(len(rows), width)
        step *= 2
    return rows / np.sqrt(width)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows divided by their length; rows are finite and not zero."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def buckets(rows: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """(row, table, probe) -> bucket, for unit rows of one width: the likeliest buckets first."""
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    padded = np.zeros((len(rows), width))
    padded[:, : rows.shape[1]] = rows
    best = min(probes, 2 * width)
    found = np.empty((len(rows), tables, probes), np.int64)
    for table in range(tables):
        vertices, losses = [], []
        for part in range(HASHES):
            signs = np.random.default_rng([_SEED, table, part, width]).choice([-1.0, 1.0], (_ROUNDS, width))
            turned = padded
            for flips in signs:
                turned = hadamard(turned * flips)
            near = np.concatenate([turned, -turned], axis=1)
            order = np.argsort(-near, axis=1, kind="stable")[:, :best]
            height = np.take_along_axis(near, order, axis=1)
            vertices.append(order)
            losses.append((height[:, :1] - height) ** 2)
        loss = (losses[0][:, :, None] + losses[1][:, None, :]).reshape(len(rows), -1)
        order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        first = np.take_along_axis(vertices[0], order // best, axis=1)
        second = np.take_along_axis(vertices[1], order % best, axis=1)
        bucket = first * (2 * width) + second
        found[:, table, : bucket.shape[1]] = bucket
        found[:, table, bucket.shape[1] :] = -1  # fewer buckets than probes
    return found


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _hash(tables: int, probes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for width in np.unique(sizes):
                some = batch.take(pa.array(np.flatnonzero(sizes == width)))
                vectors = unit(some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                found = buckets(vectors, tables, probes)
                copies = tables * probes
                table = np.broadcast_to(np.arange(tables)[:, None], (tables, probes)).reshape(-1)
                cid = np.repeat(some.column(0).to_numpy(), copies)
                n = np.repeat(some.column(2).to_numpy(), copies)
                bucket = found.reshape(len(vectors), copies)
                key = (bucket * tables + table) * (1 << 20) + width
                packed = [row.tobytes() for row in vectors]
                signed = [row.tobytes() for row in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(bucket < 0, -1, key).reshape(-1)),
                        pa.array(cid),
                        pa.array(n),
                        pa.array(np.repeat(np.array(packed, object), copies), pa.binary()),
                        pa.array(np.repeat(np.array(signed, object), copies), pa.binary()),
                        pa.array(np.tile(table, len(vectors)).astype(np.int64)),
                        pa.array(bucket.reshape(-1)),
                    ],
                    names=["key", "cid", "n", "vector", "probed", "place", "bucket"],
                )

    return rows


def _first_shared(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of probe lists (pair, table, probe): the first table with a common bucket, and the least one there."""
    table = np.full(len(left), -1)
    bucket = np.full(len(left), -1)
    for t in range(left.shape[1]):
        todo = np.flatnonzero(table < 0)
        a, b = left[todo, t, :, None], right[todo, t, None, :]
        common = np.where((a == b) & (a >= 0), a, np.iinfo(np.int64).max).min(axis=(1, 2))
        hit = common < np.iinfo(np.int64).max
        table[todo[hit]], bucket[todo[hit]] = t, common[hit]
    return table, bucket


def _verify(least_cosine: float, tables: int, probes: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches):
            slots = rows["slot"].to_numpy()
            vectors = rows["vector"].to_pylist()
            probed = np.frombuffer(b"".join(rows["probed"].to_pylist()), np.int64).reshape(-1, tables, probes)
            n, home, cid = (rows[c].to_numpy() for c in ("n", "home", "cid"))
            crossed = rows["crossed"].to_numpy(zero_copy_only=False)
            place, bucket = rows["place"].to_numpy(), rows["bucket"].to_numpy()
            linked, forest = np.zeros(len(slots), np.int64), Forest(len(slots))
            edges = np.flatnonzero(np.diff(slots)) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(slots)]):
                if end - start < 2 or len({len(v) for v in vectors[start:end]}) > 1:
                    continue
                own = np.frombuffer(b"".join(vectors[start:end])).reshape(end - start, -1)
                for at in range(0, len(own), _BLOCK):
                    a, b = np.nonzero(own[at : at + _BLOCK] @ own.T >= least_cosine)
                    a = a + at
                    later = a < b
                    left, right = a[later] + start, b[later] + start
                    left, right = _apart(left, right, crossed, home, cid)
                    for cut in range(0, len(left), 1 << 16):
                        x, y = left[cut : cut + (1 << 16)], right[cut : cut + (1 << 16)]
                        table, first = _first_shared(probed[x], probed[y])
                        here = (table == place[x]) & (first == bucket[x])
                        x, y = x[here], y[here]
                        np.add.at(linked, x, n[y])
                        np.add.at(linked, y, n[x])
                        forest.join(x, y)
            some = np.flatnonzero(linked)
            node, root = forest.edges()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([cid[some], cid[node]])),
                    pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(cid[root])]),
                    pa.array(np.concatenate([linked[some], np.zeros(len(node), np.int64)])),
                ],
                names=["a", "b", "links"],
            )

    return verify


def _apart(left, right, crossed, home, cid):
    meet = (~crossed[left] | (home[left] != home[right])) & (cid[left] != cid[right])
    return left[meet], right[meet]


def near_duplicates(
    rows: DataFrame, least_cosine: float = LEAST_COSINE, tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """(vec_id, n_links, component_id) per row of rows (vec_id, embedding)."""
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    usable = rows.where(_usable(F.col("embedding")))
    # the numbers of the classes are fixed by the stored table
    classes = write_stage(
        usable.groupBy("embedding")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "vector_classes",
    )
    hashed = classes.select("cid", "embedding", "n").mapInArrow(
        _hash(tables, probes),
        "key long, cid long, n long, vector binary, probed binary, place long, bucket long",
    )
    hashed = write_stage(hashed.where("bucket >= 0"), "vector_buckets")
    found = write_stage(
        cells(hashed, "key", "cid").mapInArrow(_verify(least_cosine, tables, probes), "a long, b long, links long"),
        "vector_links",
    )
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "cid")
    parts = connected_components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "cid")
    rooted = classes.select("cid", "least").join(parts, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    known = (
        classes.select("cid", "embedding", "n")
        .join(named.select("cid", "component_id"), "cid")
        .join(links, "cid", "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    )
    linked = usable.join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~_usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionAll(alone)
