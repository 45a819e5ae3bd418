"""Readers and writers for landing files, stage tables and serving tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.schema import RAW

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    timestamp_format: str = TIMESTAMP_FORMAT,
    multi_line: bool = False,
) -> DataFrame:
    """Scan one Parquet or CSV table.

    CSV needs a schema: nothing is inferred, and a value that is read and does
    not fit it stops the job instead of turning into null. With `multi_line`
    quoted values may hold line breaks; a file is then read by one task.
    """
    if fmt != "csv":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.format(fmt).load(path)
    if schema is None:
        raise ValueError("a CSV scan needs an explicit schema")
    formats = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    return (
        spark.read.options(header=True, escape='"', mode="FAILFAST", columnPruning=False, multiLine=multi_line, **formats)
        .schema(schema)
        .csv(path)
    )


def _typed(text: DataFrame, timestamp_format: str) -> DataFrame:
    """Landing text with the types of `RAW`; a value that does not fit stops the job, whichever columns are read.

    Prices of more than four decimals and customer numbers with a fraction do not fit.
    """
    columns, misfits = {}, []
    for field in RAW:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            continue
        value = F.nullif(F.btrim(value), F.lit(""))
        if isinstance(field.dataType, T.TimestampNTZType):
            found = F.to_timestamp_ntz(value, F.lit(timestamp_format))
            fits = found.isNotNull()
        elif field.name in ("Price", "Customer ID"):
            found = value.try_cast(field.dataType if field.name == "Price" else T.DecimalType(20, 0))
            fits = found == value.try_cast(T.DecimalType(38, 18))
            found = found.try_cast(field.dataType)
        else:
            found = value.try_cast(field.dataType)
            fits = found.isNotNull()
        columns[field.name] = found
        misfits.append((field.name, value, value.isNotNull() & ~F.coalesce(fits & found.isNotNull(), F.lit(False))))
    checked = F.lit(True)
    for name, value, misfit in misfits:
        message = F.concat(F.lit(f"malformed value of {name}: "), value)
        checked = F.when(misfit, F.raise_error(message).cast("boolean")).otherwise(checked)
    return text.where(checked).withColumns(columns)


def load_raw(
    spark: SparkSession,
    sheets: dict[str, str],
    fmt: str = "csv",
    timestamp_format: str = TIMESTAMP_FORMAT,
    multi_line: bool = False,
) -> DataFrame:
    """Concatenate the yearly landing paths by name, each row tagged with its sheet.

    Customer numbers may be written as floats (`12346.0`), as tables with gaps
    in an integer column often are. `multi_line` as in `read_table`; without it
    a quoted line break stops the job.
    """
    if fmt == "csv":
        textual = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW])
        frames = {
            sheet: _typed(read_table(spark, path, textual, fmt, timestamp_format, multi_line), timestamp_format)
            for sheet, path in sheets.items()
        }
    else:
        frames = {sheet: read_table(spark, path, RAW, fmt) for sheet, path in sheets.items()}
    return reduce(
        DataFrame.unionByName, [df.withColumn("SourceYear", F.lit(sheet)) for sheet, df in frames.items()]
    )


def landing_identity(spark: SparkSession, sheets: dict[str, str]) -> dict[str, list]:
    """What tells whether the files of each sheet are the same: their number, bytes, and two sums of hashes.

    Hashed are path, length and modification time as the file system lists them; no file is opened.
    """
    found = {}
    for sheet, path in sheets.items():
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        stated = [F.col("path"), F.col("length"), F.col("modificationTime")]
        sums = [F.sum(F.xxhash64(F.lit(seed), *stated).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
        found[sheet] = list(listed.agg(F.count("*"), F.sum("length"), *sums).first())
    return found


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """Write a table. Partitioned output is rebalanced first, so a hot value is split over several files."""
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        formats = {"timestampFormat": TIMESTAMP_FORMAT, "timestampNTZFormat": TIMESTAMP_FORMAT}
        blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer = writer.options(header=True, escape='"', **formats, **blanks)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a temporary view and return the table behind it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# The serving tables of the dashboard, by role.
BUNDLE = {
    "kpis": "executive_kpis",
    "monthly": "monthly_performance",
    "country": "country_performance",
    "rfm": "customer_rfm_dashboard",
    "risk": "high_value_at_risk",
    "products": "product_master_dashboard",
    "cross_sell": "cross_sell_opportunities",
}


def write_bundle(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> str:
    """Write the serving tables as a new version of the bundle, then publish it; return the version.

    A version is a folder of its own. The list of published versions grows by one row when all tables are
    complete, so a reader sees a whole version, the one before or this one, also when a write is stopped
    half-way. Earlier versions stay for readers that still use them.
    """
    spark = next(iter(tables.values())).sparkSession
    names = f"{folder}/published"
    line = spark.range(1).coalesce(1)
    line.select(F.lit("").alias("value")).where("id < 0").write.mode("append").text(names)  # the list is there from now on
    before = _published(spark, folder)
    version = f"{1 + (int(before.split('-')[0]) if before else 0):08d}-{uuid.uuid4().hex}"
    for role, df in tables.items():
        write_table(df, f"{folder}/{version}/{BUNDLE[role]}", fmt)
    line.select(F.lit(version).alias("value")).write.mode("append").text(names)
    return version


def _published(spark: SparkSession, folder: str) -> str | None:
    """Last published version of a bundle, or None."""
    return spark.read.schema("value string").text(f"{folder}/published").agg(F.max("value")).first()[0]


def load_bundle(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All serving tables of the last published version; a missing one raises `AnalysisException`."""
    version = _published(spark, folder)
    return {role: read_table(spark, f"{folder}/{version}/{BUNDLE[role]}") for role in BUNDLE}


def load_served(spark: SparkSession, folder: str, role: str) -> DataFrame:
    """Serving table of one role, of the last published version."""
    return read_table(spark, f"{folder}/{_published(spark, folder)}/{BUNDLE[role]}")
