"""Near duplicates by SimHash, compared through a table of distances to reference fingerprints.

Every distinct fingerprint carries its Hamming distances to `PIVOTS` reference
fingerprints. By the triangle inequality two fingerprints within the radius
differ by at most the radius in every one of these distances, so a pair is
discarded by its largest difference and only survivors are compared bit by bit.

Looking at all pairs in the table would be quadratic. Two fingerprints that
differ in `radius` bits agree on at least two of `radius + 2` bands of bits, so
pairs are drawn from the buckets of the band pairs; none is lost. Large buckets
are cut into cells, and a task returns the edges that join parts, never all
links of a dense group.

Nulls: a null text counts as empty, fingerprint zero. A null document id is
never a component id while the group has another; a group of nulls only has
the component id null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.buckets import Forest, cells, neighbours, runs
from ledgerlark.llm.components import connected_components
from ledgerlark.llm.rows import folded, unfolded
from ledgerlark.storage import write_stage

SHINGLE_WORDS = 3
RADIUS = 3
PIVOTS = 16
_SEED = 42
_CHUNK = 1 << 14
_PIECE = 1 << 20
_SPACE = re.compile(rb"[ \t-\r]")


def references(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints: the hashes of 0, 1, 2, ... as text."""
    return [xxhash.xxh64_intdigest(str(i)) for i in range(count)]


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of bounded size that end between words."""
    start = 0
    while len(text) - start > _PIECE:
        cut = _SPACE.search(text, start + _PIECE)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of the hashes of all word shingles of a UTF-8 text, as a signed long; zero without words."""
    digest, ones, count, words = xxhash.xxh64_digest, np.zeros(64, np.int64), 0, []
    for piece in _pieces(text):
        words = words[len(words) - shingle_words + 1 :] if count else words  # those that go on in this piece
        words += piece.lower().split()
        if len(words) < shingle_words:
            continue
        flat = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle_words + 1].tolist()
        ends = ends[shingle_words - 1 :].tolist()
        for at in range(0, len(starts), _CHUNK):
            spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
            hashes = b"".join([digest(flat[s:e], _SEED) for s, e in spans])
            ones += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.uint32)
        count += len(starts)
    if not count:
        return int.from_bytes(digest(b" ".join(words), _SEED), "big", signed=True) if words else 0
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """SimHash of a text column as a long."""

    @F.arrow_udf("long")
    def column(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t.as_py() or b"", shingle_words) for t in texts.cast(pa.binary())], pa.int64())

    return column(text)


def bands(count: int, bits: int = 64) -> list[tuple[int, int]]:
    """(first bit, width) of `count` bands that cover all bits."""
    edges = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pivot_table(fingerprints: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """Distances to the references, eight to a long, beside each fingerprint."""

    def packed(some: list[int]) -> Column:
        total = F.lit(0).cast("long")
        for place, value in enumerate(some):
            signed = value - (1 << 64) if value >> 63 else value
            far = F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed).cast("long"))).cast("long")
            total = total.bitwiseOR(F.shiftleft(far, 8 * place))
        return total

    values = references(pivots)
    columns = {f"far{i}": packed(values[8 * i : 8 * i + 8]) for i in range((pivots + 7) // 8)}
    return fingerprints.withColumns(columns)


def _bucketed(table: DataFrame, radius: int) -> DataFrame:
    """A row for each pair of bands, with the bits of both bands as key."""
    keys = []
    for number, pair in enumerate(combinations(bands(radius + 2), 2)):
        mask = sum(((1 << width) - 1) << first for first, width in pair)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed).cast("long"))))
    return table.withColumn("key", F.explode(F.array(*keys)))


def _compare(radius: int, columns: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches):
            slots = table["slot"].to_numpy()
            prints = table["fp"].to_numpy().view(np.uint64)
            far = np.stack([table[f"far{i}"].to_numpy() for i in range(columns)], axis=1)
            far = np.ascontiguousarray(far).view(np.int8).reshape(len(slots), -1)
            forest = Forest(len(slots))
            for left, right in neighbours(slots):
                for pivot in range(far.shape[1]):
                    near = np.abs(far[left, pivot] - far[right, pivot]) <= radius
                    left, right = left[near], right[near]
                near = np.bitwise_count(prints[left] ^ prints[right]) <= radius
                forest.join(left[near], right[near])
            node, root = forest.edges()
            signed = prints.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[node]), pa.array(signed[root])], names=["a", "b"])

    return compare


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that span all links within the radius. Input: distinct `fp`."""
    table = pivot_table(fingerprints.select("fp"))
    far = [c for c in table.columns if c.startswith("far")]
    rows = cells(_bucketed(table, radius), "key", "fp").select("slot", "fp", *far)
    return rows.mapInArrow(_compare(radius, len(far)), "a long, b long")


def components(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of rows (doc_id, fp); root names the component."""
    nodes = write_stage(rows.groupBy("fp").agg(F.min("doc_id").alias("_doc")), "fingerprints")
    found = connected_components(write_stage(links(nodes, radius), "links"))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("_doc").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fp, component_id) per row of docs (doc_id, text): the least doc_id reachable by links."""
    rows = write_stage(
        docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fp")), "document_fingerprints"
    )
    return rows.join(components(rows, radius), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of docs with one document of each component: the one with the least doc_id (any, if all are null).

    Which rows stay is found from ids, hashes and fingerprints alone; then texts are shuffled once.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    marks = write_stage(
        docs.select("doc_id", text_hash.alias("hash"), fingerprint(F.col("text"), shingle_words).alias("fp")), "fingerprinted"
    )
    groups = components(marks.select("doc_id", "fp"), radius)
    least = marks.join(groups, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = least.groupBy("root").agg(F.min(F.struct("doc_id", "hash")).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("id"), "kept.hash")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (text_hash == F.col("hash"))
    rows = folded(docs).join(write_stage(kept, "kept_documents"), same)
    # a repeated row is there once, and so is one of several without an id
    return unfolded(rows.dropDuplicates(["id", "hash"]), docs)
