"""A bit table of hashes: a broadcast of bounded size that drops most rows before a shuffle.

A hash that was put in is always found; another one is found by chance, the more often the
fuller the table. So the rows that pass still need their exact test, and the table may be any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 12, 1 << 26
BITS_PER_HASH = 32


class BitFilter:
    """Hashes of one column of longs, as a scalar subquery of at most `MOST_BITS` bits."""

    def __init__(self, hashes: DataFrame, column: str, count: int | None = None):
        """`count`: about how many hashes there are, if known; it decides the size alone."""
        count = hashes.count() if count is None else count
        self.bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_HASH * count).bit_length()))
        words = self.bits // 64
        masks = hashes.groupBy(self._word(F.col(column)).alias("id")).agg(F.bit_or(self._mask(F.col(column))).alias("mask"))
        every = hashes.sparkSession.range(words).join(masks, "id", "left")
        filled = F.struct("id", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
        # one row of bounded size
        table = every.agg(F.sort_array(F.collect_list(filled)).alias("words"))
        self.table = table.select(F.transform("words", lambda x: x["mask"])).scalar()

    def _place(self, value: Column) -> Column:
        return value.bitwiseAND(F.lit(self.bits - 1).cast("long"))

    def _word(self, value: Column) -> Column:
        return F.shiftright(self._place(value), 6)

    def _mask(self, value: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63).cast("long")).cast("int"))

    def may_hold(self, value: Column) -> Column:
        """Whether the hash may have been put in; never false for one that was."""
        return F.get(self.table, self._word(value).cast("int")).bitwiseAND(self._mask(value)) != 0
