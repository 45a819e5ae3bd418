"""One text per product, with a fixed rule for ties.

All picks read `name_facts`, the distinct (code, description) pairs. Picking by
text needs a sort-based aggregation, which is cheap there and costly on lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.storage import write_stage


def modal_names(names: DataFrame) -> DataFrame:
    """Most frequent description of each code among its sales; the smaller text wins a tie."""
    sold = names.filter((F.col("SaleLines") > 0) & F.col("StockCode").isNotNull())
    best = F.struct((-F.col("SaleLines")).alias("n"), "Description")
    return sold.groupBy("StockCode").agg(F.min(best)["Description"].alias("Description"))


def largest_names(names: DataFrame) -> DataFrame:
    """Last description of each code in text order; a null code is a group."""
    return names.groupBy("StockCode").agg(F.max("Description").alias("MaxDescription"))


def first_names(names: DataFrame, tx: DataFrame) -> DataFrame:
    """Earliest description of each code; by date, then invoice number, then text.

    Most codes have one description on their first date. Only the others need
    invoice numbers, and only their lines are looked up.
    """
    starts = names.groupBy(F.col("StockCode").alias("_code")).agg(F.min("FirstDate").alias("_start"))
    on_start = F.col("StockCode").eqNullSafe(F.col("_code")) & F.col("FirstDate").eqNullSafe(F.col("_start"))
    earliest = write_stage(names.join(starts, on_start, "left_semi"), "earliest_names")
    picked = earliest.groupBy("StockCode").agg(F.count("*").alias("_rivals"), F.max("Description").alias("Description"))
    clear = picked.filter("_rivals = 1").select("StockCode", "Description")
    disputed = picked.filter("_rivals > 1").select(F.col("StockCode").alias("_code"))
    contested = write_stage(
        earliest.join(disputed, F.col("StockCode").eqNullSafe(F.col("_code")), "left_semi"), "contested_names"
    )
    if contested.isEmpty():
        return clear
    rivals = contested.select(
        F.col("StockCode").alias("_code"), F.col("Description").alias("_text"), F.col("FirstDate").alias("_date")
    )
    invoices = (
        tx.join(
            rivals,
            F.col("StockCode").eqNullSafe(F.col("_code"))
            & (F.col("Description") == F.col("_text"))
            & F.col("InvoiceDate").eqNullSafe(F.col("_date")),
            "left_semi",
        )
        .groupBy("StockCode", "Description")
        .agg(F.min("InvoiceNo").alias("_invoice"))
    )
    decided = invoices.groupBy("StockCode").agg(
        F.min_by("Description", F.struct("_invoice", "Description")).alias("Description")
    )
    return clear.unionByName(decided)


def first_row(df: DataFrame, key: str, *order: str) -> DataFrame:
    """First row per key in the given order, as a lookup table for a dimension."""
    others = [name for name in df.columns if name != key]
    ranked = F.struct(*order, *[name for name in others if name not in order])
    return df.groupBy(key).agg(F.min(ranked).alias("_row")).select(key, *[F.col(f"_row.{name}") for name in others])
