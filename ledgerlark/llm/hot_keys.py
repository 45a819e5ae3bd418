"""Joins whose keys can hold any share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000


def join_one(rows: DataFrame, groups: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of rows with `groups`, which has one row per key and the number of its rows in `count`.

    A key with a thousandth of all counted rows or more is hot. There are a thousand of
    them at most, so they are broadcast and their rows stay where they are; the rows of
    all other keys are shuffled. Both inputs are read twice: pass stage tables.
    """
    total = groups.agg(F.sum(count)).scalar()
    hot = F.broadcast(groups.where(F.col(count) * HOT_SHARE >= total))
    cold = groups.where(F.col(count) * HOT_SHARE < total)
    near = rows.join(hot, keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return near.unionByName(far)
