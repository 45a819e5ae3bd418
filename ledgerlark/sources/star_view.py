"""Retail landing sheets seen through the order tables of a star schema.

Every line item becomes one invoice line; the key arithmetic below only gives
lines their role (return, fee, write-off, unknown customer, ...). April 1998 is
in both yearly sheets and some lines of the later sheet are there twice, so the
sheets overlap the way yearly extracts do.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.schema import PRICE

# Part keys whose remainder by 400 stands for a service code.
SERVICE_CODES = ["POST", "DOT", "M", "S", "D", "BANK CHARGES", "AMAZONFEE", "gift_0001_10"]


def raw_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Raw invoice lines of both sheets, in one pass over the line items."""

    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    accounting = order % 101 == 0
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (line <= 3)
    write_off = (order + line) % 211 == 0

    invoice = F.concat(
        F.when(accounting, "A").when(returned, "C").otherwise(""), order.cast("string")
    )
    stock_code = part.cast("string")
    for remainder, code in enumerate(SERVICE_CODES):
        stock_code = F.when(part % 400 == remainder, code).otherwise(stock_code)
    name = F.upper("p_name")
    description = (
        F.when(part % 61 == 0, None)
        .when(part % 67 == 0, F.concat(F.lit("damaged "), F.col("p_name")))
        .when(part % 71 == 0, "Manual")
        .when(part % 73 == 0, "SAMPLES")
        .when(line == 7, F.concat(name, F.lit(" OLD")))
        .otherwise(name)
    )
    units = F.col("l_quantity").cast("bigint")
    outgoing = ~accounting & (returned | write_off | ((order * 5 + line) % 401 == 0))
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("bigint")
    price = (cents * F.lit(Decimal("0.01"))).cast(PRICE)
    price = (
        F.when(write_off | ((order * 3 + line) % 53 == 0), F.lit(0).cast(PRICE))
        .when((order * 7 + line) % 997 == 0, -price)
        .otherwise(price)
    )
    date = F.col("o_orderdate")
    overlap, later = F.lit("1998-04-01").cast("timestamp_ntz"), F.lit("1998-05-01").cast("timestamp_ntz")
    sheets = F.array_compact(
        F.array(
            F.when(date < later, "S1"),
            F.when(date >= overlap, "S2"),
            F.when((date >= later) & (order % 37 == 0), "S2"),
        )
    )

    # Orders meet their customers before the line items, so that the lines move twice, not four times.
    # Both sides of that join grow with the data: neither is to be broadcast on an estimate.
    placed = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = (
        table("lineitem")
        .join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return lines.select(
        invoice.alias("Invoice"),
        stock_code.alias("StockCode"),
        description.alias("Description"),
        F.when(outgoing, -units).otherwise(units).alias("Quantity"),
        date.alias("InvoiceDate"),
        price.alias("Price"),
        F.when(F.col("o_custkey") % 9 == 0, None).otherwise(F.col("o_custkey")).alias("Customer ID"),
        F.col("n_name").alias("Country"),
        F.explode(sheets).alias("SourceYear"),
    )
