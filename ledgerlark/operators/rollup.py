"""Roll-ups of transaction lines to invoices, customers, markets and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.measures import month_of, only
from ledgerlark.schema import PRICE


def order_facts(tx: DataFrame) -> DataFrame:
    """One row per invoice, customer, country, month and transaction type.

    Every commercial and customer result follows from this table, so the lines
    are scanned and shuffled once. Partial sums merge a large invoice or
    customer before the shuffle.
    """
    keys = [
        "InvoiceNo", "CustomerID", "Country", month_of("InvoiceDate").alias("Month"), "TransactionType",
        "IsRevenueEligible", "IsReturn",
    ]
    return tx.groupBy(*keys).agg(
        F.count("*").alias("Lines"),
        F.sum("LineRevenue").cast(PRICE).alias("Revenue"),
        F.sum("Quantity").alias("Units"),
        F.min("InvoiceDate").alias("FirstDate"),
        F.max("InvoiceDate").alias("LastDate"),
    )


def _per_invoice(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys and known invoices, with what the invoice holds for the key.

    Only keys and two flags are shuffled, and every distinct count follows from
    this one step.
    """
    return (
        df.filter(F.col("InvoiceNo").isNotNull())
        .groupBy(*keys, "InvoiceNo")
        .agg(F.max("IsRevenueEligible").alias("HasSale"), F.max("IsReturn").alias("HasReturn"))
    )


def _invoice_counts(per_invoice: DataFrame, keys: list[str]) -> DataFrame:
    """Invoices per key: all, with a sale, with a return.

    Counts merge before the shuffle, so a key that holds most rows is no hot spot.
    """
    return per_invoice.groupBy(*keys).agg(
        F.count("*").alias("Orders"),
        F.count_if("HasSale").alias("SalesOrders"),
        F.count_if("HasReturn").alias("ReturnOrders"),
    )


_COUNTS = ["Orders", "SalesOrders", "ReturnOrders"]


def _attach_counts(sums: DataFrame, counts: DataFrame, keys: list[str], nulls: bool) -> DataFrame:
    """Sums with the invoice counts of the same keys; zero where no invoice is known."""
    if not keys:
        found = counts.select(F.struct(*_COUNTS)).scalar()
        return sums.withColumn("_found", found).select("*", "_found.*").drop("_found")
    if nulls:
        counts = counts.withColumnsRenamed({key: f"_{key}" for key in keys})
        joined = sums.join(counts, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys], "left")
        joined = joined.drop(*[f"_{key}" for key in keys])
    else:
        joined = sums.join(counts, keys, "left")
    return joined.na.fill(0, _COUNTS)


def roll_up(orders: DataFrame, *keys: str, nulls: bool = True) -> DataFrame:
    """Measures of `order_facts` per key, with exact distinct invoice counts.

    Sums and counts are two branches: sums merge to one row per key and task
    before the shuffle, and the per-invoice shuffle of the counts stays narrow.
    Without null keys (`nulls=False`) the two meet without another shuffle.
    """
    sale, returned = F.col("IsRevenueEligible"), F.col("IsReturn")
    sums = orders.groupBy(*keys).agg(
        F.sum("Lines").alias("Lines"),
        F.sum(only(sale, "Lines")).alias("SaleLines"),
        F.sum("Revenue").alias("NetAll"),
        F.sum(only(sale, "Revenue")).alias("GrossRevenue"),
        F.sum(only(returned, "Revenue")).alias("ReturnValue"),
        F.sum(only(sale, "Units")).alias("UnitsSold"),
        F.sum(only(returned, "Units")).alias("ReturnedUnits"),
        F.min(F.when(sale, F.col("FirstDate"))).alias("FirstSale"),
        F.max(F.when(sale, F.col("LastDate"))).alias("LastSale"),
    )
    counts = _invoice_counts(_per_invoice(orders, list(keys)), list(keys))
    return _attach_counts(sums, counts, list(keys), nulls)


def with_distinct(rolled: DataFrame, rows: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """`rolled` with the number of distinct values of columns of `rows` per key, null keys included.

    `names` maps result names to columns. Every count is a branch of its own that
    reads and shuffles its column and the keys; rows are never multiplied.
    """
    for name, column in names.items():
        if not keys:
            # distinct first: counts of the same rows would be merged into one step that multiplies them
            rolled = rolled.withColumn(name, rows.select(column).distinct().agg(F.count(column)).scalar())
            continue
        found = rows.select(*keys, column).distinct().groupBy(*[F.col(key).alias(f"_{key}") for key in keys])
        found = found.agg(F.count(column).alias(name))
        same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
        rolled = rolled.join(found, same, "left").drop(*[f"_{key}" for key in keys]).na.fill(0, [name])
    return rolled


def customer_facts(orders: DataFrame) -> DataFrame:
    """One row per identified customer, with or without sales."""
    return roll_up(orders.filter(F.col("CustomerID").isNotNull()), "CustomerID", nulls=False)


def _product_sums(tx: DataFrame, *keys) -> DataFrame:
    """Sums per key (nulls included).

    `SaleLines` counts all sale lines, `SalesLines` those with an invoice number.
    """
    sale, returned = F.col("IsRevenueEligible"), F.col("IsReturn")
    price = F.when(sale, F.col("UnitPrice"))
    return tx.groupBy(*keys).agg(
        F.count("*").alias("Lines"),
        F.count_if(sale).alias("SaleLines"),
        F.count_if(sale & F.col("InvoiceNo").isNotNull()).alias("SalesLines"),
        F.count_if(returned).alias("ReturnLines"),
        F.sum("LineRevenue").alias("NetAll"),
        F.sum(only(sale, "LineRevenue")).alias("GrossRevenue"),
        F.sum(only(returned, "LineRevenue")).alias("ReturnValue"),
        F.sum(only(sale, "Quantity")).alias("UnitsSold"),
        F.sum(only(returned, "Quantity")).alias("ReturnedUnits"),
        F.sum(price).alias("PriceSum"),
        F.count(price).alias("PriceCount"),
    )


def product_sums(tx: DataFrame) -> DataFrame:
    """Sums per stock code (null included). Lines of a code merge in each task, which those of a code and month rarely do."""
    return _product_sums(tx, "StockCode")


def product_months(tx: DataFrame) -> DataFrame:
    """Sums per stock code and month (nulls included)."""
    return _product_sums(tx, "StockCode", month_of("InvoiceDate").alias("Month"))


def product_orders(tx: DataFrame) -> DataFrame:
    """One row per stock code and invoice: the base of order counts and of baskets."""
    return _per_invoice(tx, ["StockCode"])


def _sum_type(kind: T.DataType) -> T.DataType:
    """Type of a sum over a column of this type."""
    return T.DecimalType(min(kind.precision + 10, 38), kind.scale) if isinstance(kind, T.DecimalType) else T.LongType()


def product_facts(sums: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per stock code (null included), from `product_sums` or `product_months` and `product_orders`."""
    measures = [f for f in sums.schema if f.name not in ("StockCode", "Month")]
    if "Month" in sums.columns:
        sums = sums.groupBy("StockCode").agg(*[F.sum(f.name).alias(f.name) for f in measures])
    else:
        wide = [F.col(f.name).cast(_sum_type(f.dataType)).alias(f.name) for f in measures]
        sums = sums.select("StockCode", *wide)
    return _attach_counts(sums, _invoice_counts(orders, ["StockCode"]), ["StockCode"], True)


def name_facts(tx: DataFrame) -> DataFrame:
    """One row per stock code and non-null description: sale lines and first date.

    The picks of one description per product read this short table.
    """
    return (
        tx.filter(F.col("Description").isNotNull())
        .groupBy("StockCode", "Description")
        .agg(F.count_if("IsRevenueEligible").alias("SaleLines"), F.min("InvoiceDate").alias("FirstDate"))
    )
