"""Table profiles: null counts, duplicates, numeric summaries, frequencies, top rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.bit_filter import BitFilter
from ledgerlark.operators.selection import long_values, quantiles_of
from ledgerlark.storage import write_stage


def to_long(df: DataFrame, groups: list[str], cells: dict[str, Column], name: str = "metric") -> DataFrame:
    """One row per named cell instead of one column per cell; values are doubles."""
    items = F.array(*[F.struct(F.lit(n).alias(name), c.cast("double").alias("value")) for n, c in cells.items()])
    return df.select(*groups, F.explode(items).alias("_cell")).select(*groups, f"_cell.{name}", "_cell.value")


def null_report(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """Missing count and percentage per column that misses anything, in one aggregation."""
    missing = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns]
    counted = df.groupBy(*groups).agg(F.count("*").alias("_rows"), *missing)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing_count")) for c in columns])
    return (
        counted.select(*groups, "_rows", F.explode(cells).alias("_cell"))
        .select(*groups, "_cell.column", "_cell.missing_count", "_rows")
        .filter("missing_count > 0")
        .withColumn("missing_pct", F.round(F.col("missing_count").cast("double") / F.col("_rows") * 100, 2))
        .drop("_rows")
    )


def row_hash(columns: list[str]) -> Column:
    """Hash of the values of a row, whatever the columns are called."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def repeated_hashes(df: DataFrame) -> DataFrame:
    """(hash, copies) of the rows whose hash occurs more than once: all that can have a duplicate.

    Only hashes are shuffled, merged in each task before.
    """
    counted = df.groupBy(row_hash(df.columns).alias("hash")).agg(F.count("*").alias("copies"))
    return counted.filter("copies > 1")


def row_counts(df: DataFrame, groups: list[str], repeated: DataFrame) -> DataFrame:
    """Rows and duplicate rows (beyond the first of each kind) per group; `repeated` is `repeated_hashes` of df."""
    counted = df.groupBy(*groups).agg(F.count("*").alias("rows"))
    kinds = _repeated(df, repeated)
    extra = kinds.groupBy(*[F.col(g).alias(f"_{g}") for g in groups]).agg(F.sum(F.col("_copies") - 1).alias("duplicate_rows"))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]
    return counted.join(extra, same, "left").drop(*[f"_{g}" for g in groups]).na.fill(0, ["duplicate_rows"])


def count_copies(df: DataFrame, repeated: DataFrame, hashed: list[str] | None = None) -> DataFrame:
    """Duplicate rows over all columns; `repeated` holds the hashes of the columns `hashed` that can occur again."""
    return _repeated(df, repeated, hashed).agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def _repeated(df: DataFrame, repeated: DataFrame, hashed: list[str] | None = None) -> DataFrame:
    """Distinct rows among those whose hash may occur again, with `_copies`; no other row is shuffled."""
    suspect = BitFilter(repeated, "hash").may_hold(row_hash(hashed or df.columns))
    return df.where(suspect).groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_copies"))


def numeric_summary(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """Count, mean, deviation (both to six digits), extremes and exact quartiles per numeric column."""

    def statistics(name):
        value = F.col(f"`{name}`").cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.round(F.avg(value), 6).alias("mean"),
            F.round(F.stddev_samp(value), 6).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    basic = df.groupBy(*groups).agg(F.array(*[statistics(c) for c in columns]).alias("_columns"))
    basic = basic.select(*groups, F.explode("_columns").alias("_column")).select(*groups, "_column.*")
    basic = write_stage(basic, "numeric_summary")
    keys = [*groups, "metric"]
    spans = basic.select(*groups, F.col("column").alias("metric"), F.col("count").alias("n"), F.col("min").alias("lo"), F.col("max").alias("hi"))
    values = long_values(df, {c: F.col(f"`{c}`") for c in columns}, groups)
    quartiles = quantiles_of(values, keys, spans, [0.25, 0.5, 0.75])
    names = {key: f"_{key}" for key in keys} | {"q0": "q25", "q1": "q50", "q2": "q75"}
    same = [F.col("column" if key == "metric" else key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    # a column without any value in a group has no quartiles, but a row
    return basic.join(quartiles.withColumnsRenamed(names), same, "left").drop(*[f"_{key}" for key in keys])


def value_counts(df: DataFrame, column: str, name: str = "rows") -> DataFrame:
    """Frequency of each value."""
    return df.groupBy(column).agg(F.count("*").alias(name))


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percent of the column total per row; the total is a scalar subquery."""
    total = df.agg(F.sum(value).cast("double")).scalar()
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total) * 100)


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int, name: str = "position") -> DataFrame:
    """First `n` rows per group; each task keeps `n` rows per group before the shuffle."""
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("bigint")).filter(F.col(name) <= n)


def top_of_each(
    df: DataFrame, group: str, names: list, order: list[Column], n: int, name: str = "position"
) -> DataFrame:
    """First `n` rows of each of a few known groups, by a bounded heap per task; no group is sorted."""
    best = [df.filter(F.col(group) == value).orderBy(*order).limit(n) for value in names]
    rows = reduce(DataFrame.unionByName, best) if best else df.limit(0)
    # at most n rows of each
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("bigint"))
