"""Aggregate measures and output formatting.

Money is summed as exact decimals and turned into doubles only in results.
Three definitions of net revenue are kept apart: `NetAll` sums every line,
`net_commercial` sums sales and returns, and the product and customer stages
apply the latter to entities that have sales.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def only(flag: Column | str, value: Column | str) -> Column:
    """Value where the flag holds, else zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(flag if isinstance(flag, Column) else F.col(flag), value).otherwise(0)


def net_commercial() -> Column:
    """Sales plus (negative) returns of a rolled-up row."""
    return F.col("GrossRevenue") + F.col("ReturnValue")


def number(value: Column | str, digits: int | None = None) -> Column:
    """Double, rounded first when `digits` is given."""
    value = F.col(value) if isinstance(value, str) else value
    return (value if digits is None else F.round(value, digits)).cast("double")


def ratio(top: Column | str, bottom: Column | str, scale: float = 1.0) -> Column:
    """`scale * top / bottom` as a double, null where the bottom is zero."""
    top, bottom = number(top), number(bottom)
    return F.try_divide(top if scale == 1.0 else F.lit(scale) * top, bottom)


def percent(top: Column | str, bottom: Column | str) -> Column:
    """Percentage rounded to two digits, null where the bottom is zero."""
    return F.round(ratio(top, bottom, 100.0), 2)


def month_of(timestamp: Column | str) -> Column:
    """First instant of the month, as a timestamp without time zone."""
    return F.trunc(F.to_date(timestamp), "MM").cast("timestamp_ntz")
