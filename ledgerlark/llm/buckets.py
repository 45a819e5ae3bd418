"""Buckets of candidates, cut into cells of bounded size.

A bucket key can hold any share of all rows. Rows of a large bucket are dealt
to blocks, and every pair of blocks becomes a cell of its own: each pair of
rows still meets, no task gets a whole bucket, and no pair is written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_ROWS = 4096


def cells(rows: DataFrame, key: str, member: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Rows of keys with two members or more, with `slot`, `home` and `crossed`, sorted by slot in each partition.

    `slot` names the cell, `home` the block of the row. In a cell with `crossed`
    only rows with different homes have to be compared; the others meet elsewhere.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.greatest(F.lit(1), F.ceil(2 * F.col("_n") / cell_rows)).cast("long")
    home = F.pmod(F.xxhash64(member, F.lit(7)), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    return (
        rows.join(sizes.select(key, blocks.alias("_blocks")), key)
        .withColumn("home", home)
        .withColumn("_other", other)
        .withColumn("slot", F.xxhash64(key, F.least("home", "_other"), F.greatest("home", "_other")))
        .withColumn("crossed", F.col("home") != F.col("_other"))
        .drop("_blocks", "_other", key)
        .repartition(F.col("slot"))
        .sortWithinPartitions("slot")
    )


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that never split the rows of one slot, from batches sorted by slot."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table])
        slots = table["slot"].to_numpy()
        start = int(np.searchsorted(slots, slots[-1]))
        if start:
            yield table.slice(0, start).combine_chunks()
        kept = table.slice(start)
    if kept is not None:
        yield kept.combine_chunks()


def neighbours(slots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of row numbers with equal slot, as arrays, one distance in the order at a time."""
    step, left = 1, np.flatnonzero(slots[:-1] == slots[1:])
    while left.size:
        yield left, left + step
        step += 1
        left = left[left + step < len(slots)]
        left = left[slots[left] == slots[left + step]]


class Forest:
    """Union of row numbers; keeps only what joins two parts."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def _find(self, node: int) -> int:
        while self.root[node] != node:
            self.root[node] = self.root[self.root[node]]
            node = self.root[node]
        return node

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        apart = np.flatnonzero(self.root[left] != self.root[right])
        for i in apart:
            a, b = self._find(left[i]), self._find(right[i])
            if a != b:
                self.root[max(a, b)] = min(a, b)
        if apart.size:
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and the row number each is joined to, without loops."""
        node = np.flatnonzero(self.root != np.arange(len(self.root)))
        return node, self.root[node]
