"""Column lookup over tables whose column names vary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def find_column(df: DataFrame, candidates: list[str]) -> str | None:
    """First candidate present in the table, compared without case and outer blanks."""
    present = {name.strip().lower(): name for name in df.columns}
    return next((present[c.strip().lower()] for c in candidates if c.strip().lower() in present), None)


def first_value(df: DataFrame, candidates: list[str], default: float | str | Column = 0) -> Column:
    """First non-null of the candidate columns that exist, else the default."""
    found = [F.col(f"`{name}`") for name in candidates if name in df.columns]
    return F.coalesce(*found, F.lit(default)) if found else F.lit(default)


def find_date_column(df: DataFrame, candidates: list[str], min_parsed: int = 3) -> str | None:
    """Named date column, else the first non-numeric one with enough values that read as dates."""
    named = find_column(df, candidates)
    if named is not None:
        return named
    textual = [f.name for f in df.schema if not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    if not textual:
        return None
    parsed = df.agg(
        *[F.count(F.col(f"`{name}`").cast("string").try_cast("timestamp_ntz")).alias(name) for name in textual]
    ).first()
    return next((name for name in textual if parsed[name] >= min_parsed), None)
