"""Exact quantiles by histogram refinement, without sorting.

Every wanted rank starts with the interval from the least to the greatest value.
A pass over the rows counts the values of each interval in buckets; the bucket
that holds the rank, cut to the least and greatest value met in it, is the
interval of the next pass. It is over when both are equal: that value has the
rank. Buckets are even steps of the logarithm first and of the value after
that, so a long tail costs no pass of its own: values with four decimals up to a
billion take three.

Rows are counted where they are; a shuffle carries one row per bucket and task.
A value that most rows share is one bucket and costs nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.storage import write_stage

BUCKETS = 1 << 14


def long_values(df: DataFrame, metrics: dict[str, Column], groups: list[str]) -> DataFrame:
    """(groups, metric, value) per row and metric; no null, and no NaN, which counts as missing."""
    cells = F.array(*[F.struct(F.lit(name).alias("metric"), col.cast("double").alias("value")) for name, col in metrics.items()])
    rows = df.select(*groups, F.explode(cells).alias("_cell")).select(*groups, "_cell.metric", "_cell.value")
    return rows.where("value IS NOT NULL AND NOT isnan(value)")


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys, null keys included; the key columns of the left side stay."""
    right = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return left.join(right, same, how).drop(*[f"_{key}" for key in keys])


def _bucket(first_pass: bool, buckets: int) -> Column:
    """Place of `value` between `lo` and `hi`, lo < hi, in a number of buckets; never falls as the value grows."""
    value, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    even = (value - lo) / (hi - lo)
    # an infinite value counts as one beyond all finite logarithms, which end at 710
    logs = [F.signum(x) * F.least(F.log1p(F.abs(x)), F.lit(1000.0)) for x in (value, lo, hi)]
    infinite = (lo == float("-inf")) | (hi == float("inf"))
    by_log = (logs[2] > logs[1]) if first_pass else infinite
    place = F.when(by_log, F.try_divide(logs[0] - logs[1], logs[2] - logs[1])).otherwise(even)
    return F.least(F.floor(place * buckets), F.lit(buckets - 1)).cast("int")


def values_at(values: DataFrame, keys: list[str], spans: DataFrame, places: Column, buckets: int = BUCKETS) -> DataFrame:
    """(keys, place, value): the value at each 0-based place of the ascending order of each key.

    `values` has the keys and a double `value` without nulls; `spans` one row per key with its least
    and greatest value `lo` and `hi`, and whatever `places`, an array of longs, needs.
    """
    wanted = spans.select(*keys, F.explode(F.array_distinct(places)).alias("place"), "lo", "hi", F.lit(0).cast("long").alias("below"))
    state, first_pass = write_stage(wanted, "selection"), True
    while not (unsure := state.where("lo < hi")).isEmpty():
        parts = unsure.select(*keys, "lo", "hi").distinct()
        counted = (
            _same(values, parts, keys)
            .where("value BETWEEN lo AND hi")
            .groupBy(*keys, "lo", _bucket(first_pass, buckets).alias("bucket"))
            .agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
        )
        # at most `buckets` rows per interval
        earlier = Window.partitionBy(*keys, "lo").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        inside = F.col("place") - F.col("below") - F.col("before")
        closer = (
            _same(unsure, counted, [*keys, "lo"])
            .where((inside >= 0) & (inside < F.col("n")))
            .select(*keys, "place", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("below") + F.col("before")).alias("below"))
        )
        state, first_pass = write_stage(state.where("lo = hi").unionByName(closer), "selection"), False
    return state.select(*keys, "place", F.col("lo").alias("value"))


def spans_of(values: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the number of values, the least and the greatest one."""
    return values.groupBy(*keys).agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def quantiles_of(
    values: DataFrame, keys: list[str], spans: DataFrame, probabilities: list[float], buckets: int = BUCKETS
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key: columns `q0`, `q1`, ... follow `probabilities`.

    `spans` is `spans_of` the values, as a stage table; keys without values have no row.
    """
    spans = spans.where("n > 0")
    at = [F.lit(p) * (F.col("n") - 1) for p in probabilities]
    ends = [end(place).cast("long") for place in at for end in (F.floor, F.ceil)]
    found = values_at(values, keys, spans, F.array(*ends), buckets)
    per_key = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("_found"))

    def between(place: Column) -> Column:
        # The weighting that the built-in `percentile` uses.
        part = place - F.floor(place)
        low, high = (F.element_at("_found", end(place).cast("long")) for end in (F.floor, F.ceil))
        return low * (1 - part) + high * part

    joined = _same(spans, per_key, keys)
    return joined.select(*keys, *[between(place).alias(f"q{i}") for i, place in enumerate(at)])


def exact_quantiles(
    df: DataFrame, metrics: dict[str, Column], probabilities: list[float], groups: list[str] | None = None
) -> DataFrame:
    """Exact quantiles per group and metric: (groups, metric, q0, q1, ...)."""
    groups = groups or []
    values, keys = long_values(df, metrics, groups), [*groups, "metric"]
    return quantiles_of(values, keys, write_stage(spans_of(values, keys), "value_spans"), probabilities)
