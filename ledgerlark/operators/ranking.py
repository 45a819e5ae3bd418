"""Exact global ranks, running totals and shares without a one-task window.

A window without partition keys runs in a single task. Here the rows are range
sorted instead, numbered inside each range, and each range is shifted by the
size of the ranges before it. The sorted rows are written to a stage table
first: the ranges are then stored facts, the same for the row branch and the
size branch, and after the loss of an executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.storage import write_stage

# `monotonically_increasing_id` keeps the partition number above this bit.
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in the global order with `_slot`, their range and row in it. Write it once; ranks are read from that table."""
    return df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())


def _ranges(stored: DataFrame, amount: Column | None) -> tuple[DataFrame, DataFrame]:
    """Rows of a numbered table with range and row number, and one row per range with what lies before it."""
    rows = stored.withColumns(
        {
            "_range": F.shiftright("_slot", _ROW_BITS),
            "_row": F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    measures = [F.count("*").alias("_rows")] + ([F.sum(amount).alias("_amount")] if amount is not None else [])
    # At most one row per sort partition, hence the plain window and the broadcast below.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = rows.groupBy("_range").agg(*measures)
    shifted = [
        "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(everything).alias("_all_rows"),
    ]
    if amount is not None:
        shifted.append(F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_amount_before"))
    return rows, ranges.select(*shifted)


def _sorted_ranges(df: DataFrame, order: list[Column], amount: Column | None) -> tuple[DataFrame, DataFrame]:
    return _ranges(write_stage(numbered(df, order), "ranked"), amount)


def positions(stored: DataFrame, name: str = "position", total: str | None = None) -> DataFrame:
    """1-based position of every row of a numbered table; `total` adds the row count. Nothing is sorted or written."""
    rows, ranges = _ranges(stored, None)
    placed = rows.join(F.broadcast(ranges), "_range").withColumn(name, F.col("_rows_before") + F.col("_row") + 1)
    if total:
        placed = placed.withColumn(total, F.col("_all_rows"))
    columns = [c for c in stored.columns if c != "_slot"]
    return placed.select(*columns, name, *([total] if total else []))


def global_rank(df: DataFrame, order: list[Column], name: str = "position", total: str | None = None) -> DataFrame:
    """1-based position of every row in the global order; `total` adds the row count.

    The order must be unique (end it with a key) to give one answer.
    """
    return positions(write_stage(numbered(df, order), "ranked"), name, total)


def running_total(
    df: DataFrame, order: list[Column], amount: str, name: str, position: str | None = None
) -> DataFrame:
    """Running sum of `amount` in the global order, and the position on request."""
    rows, ranges = _sorted_ranges(df, order, F.col(amount))
    result = _run(rows, ranges, amount, name)
    if position:
        result = result.withColumn(position, F.col("_rows_before") + F.col("_row") + 1)
    return result.select(*df.columns, name, *([position] if position else []))


def _run(rows: DataFrame, ranges: DataFrame, amount: str, name: str) -> DataFrame:
    """Running sum: the sum inside the range plus what lies before the range."""
    inside = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("_inside", F.sum(amount).over(inside)).join(F.broadcast(ranges), "_range")
    return summed.withColumn(name, F.col("_amount_before") + F.col("_inside"))


def rank_bucket(position: Column, total: Column, buckets: int) -> Column:
    """Quantile bucket (1..buckets) of a rank, with edges at equal steps of the rank range.

    Not the same as `ntile`: 12 ranks in 5 buckets give sizes 3, 2, 2, 2, 3.
    """
    steps = F.greatest(total - 1, F.lit(1))
    return F.greatest(
        F.lit(1), F.floor((buckets * (position - 1) + steps - 1) / steps)
    ).cast("bigint")


def ntile_bucket(position: Column, total: Column, buckets: int) -> Column:
    """`ntile` of a rank: the first `total % buckets` tiles hold one row more."""
    size, extra = F.floor(total / buckets), total % buckets
    wide = extra * (size + 1)
    return (
        F.when(position <= wide, F.floor((position - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor((position - 1 - wide) / F.greatest(size, F.lit(1))) + 1)
        .cast("bigint")
    )


def share_of_top(
    ranked: DataFrame, value: str, position: Column, total: Column, percents: list[int], rule: str, suffix: str
) -> DataFrame:
    """Share of the total held by the top p percent of ranked rows, one column `top_<p><suffix>` per p.

    `rule` is "ceil" (k = ceil(n*p)) or "floor" (k = max(1, floor(n*p))).
    """

    def size(percent):
        # Integer arithmetic: n*p/100 in doubles can fall just beside a whole number.
        whole = total * percent
        return F.floor((whole + 99) / 100) if rule == "ceil" else F.greatest(F.lit(1), F.floor(whole / 100))

    held = [F.sum(F.when(position <= size(p), F.col(value)).otherwise(0)).alias(f"_top{p}") for p in percents]
    sums = ranked.agg(F.sum(value).alias("_all"), *held)
    whole = F.col("_all").cast("double")
    return sums.select(
        *[
            F.round(F.try_divide(F.lit(100.0) * F.col(f"_top{p}").cast("double"), whole), 2).alias(f"top_{p}{suffix}")
            for p in percents
        ]
    )


def top_share(
    stored: DataFrame, value: str, percents: list[int], rule: str, suffix: str = "pct_revenue_share",
    leading: Column | str | None = None,
) -> DataFrame:
    """`share_of_top` of a table numbered by falling value.

    `leading` may limit it to rows that stand before all others in that order.
    """
    ranked = positions(stored, "_at")
    if leading is not None:
        ranked = ranked.filter(leading)
    return share_of_top(ranked, value, F.col("_at"), ranked.agg(F.count("*")).scalar(), percents, rule, suffix)


def _value_counts(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Distinct non-null values per metric with their frequency, in long form."""
    cells = F.array(*[F.struct(F.lit(name).alias("metric"), col.alias("value")) for name, col in metrics.items()])
    return (
        df.select(F.explode(cells).alias("_cell"))
        .select("_cell.metric", "_cell.value")
        .filter(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.count("*").alias("_count"))
    )


def _cumulative(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Value counts with the cumulative count inside each metric."""
    counted = _value_counts(df, metrics)
    rows, ranges = _sorted_ranges(counted, [F.col("metric").asc(), F.col("value").asc()], F.col("_count"))
    # One row per metric, of which there are a few: all counts sorted before it.
    before = Window.orderBy("metric").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("metric").agg(F.sum("_count").alias("_n"))
    spans = spans.select("metric", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return _run(rows, ranges, "_count", "_all").join(spans, "metric").select(
        "metric", "value", "_count", (F.col("_all") - F.col("_start")).alias("_upto")
    )


def mean_ranks(df: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Ascending rank per numeric column, tied values sharing their mean rank; null for null.

    `metrics` maps a column to the name of its rank column. Ranks are found per
    distinct value and joined back, so a value that most rows share costs one row.
    """
    spread = _cumulative(df, {name: F.col(name).cast("decimal(38,4)") for name in metrics})
    mean = F.col("_upto") - (F.col("_count") - 1) / F.lit(2.0)
    for name, target in metrics.items():
        ranks = spread.filter(F.col("metric") == name).select(F.col("value").alias("_value"), mean.alias(target))
        df = df.join(ranks, F.col(name).cast("decimal(38,4)") == F.col("_value"), "left").drop("_value")
    return df
