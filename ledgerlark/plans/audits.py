"""Audits of the raw sheets and validation of the clean table.

All metrics of a kind come from one aggregation over all sheets, grouped by
`SourceYear`, instead of a pass per sheet and metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.measures import number
from ledgerlark.functions.text import starts_with
from ledgerlark.operators.cleaning import classify_audit
from ledgerlark.operators.profile import (
    count_copies, null_report, numeric_summary, row_counts, to_long, top_of_each, top_per_group,
)
from ledgerlark.operators.rollup import with_distinct
from ledgerlark.schema import CLEAN_BASE, RAW

SHEET = ["SourceYear"]
RAW_COLUMNS = RAW.names
_LINE = ["Invoice", "StockCode", "Description", "Quantity", "Price"]
_LINE_ORDER = ["Invoice", "StockCode", "Description", "Quantity", "Price", "InvoiceDate", "Customer ID"]


def _line_order(*first):
    return [*first, *[F.col(c).asc_nulls_last() for c in _LINE_ORDER]]


# ---- raw table profile -------------------------------------------------------


def profile_rows(raw: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows, columns and duplicate rows per sheet; `repeated` is `repeated_hashes` of the raw lines."""
    return row_counts(raw, SHEET, repeated).withColumn("columns", F.lit(len(RAW_COLUMNS)).cast("bigint"))


def profile_types(raw: DataFrame) -> DataFrame:
    """Column names, types and non-null counts of the raw table, one row per column."""
    kinds = {field.name: field.dataType.simpleString() for field in raw.schema if field.name in RAW_COLUMNS}
    counted = raw.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in kinds])
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"), F.col(f"`{c}`").alias("non_null"))
            for c, kind in kinds.items()
        ]
    )
    return counted.select(F.explode(cells).alias("_cell")).select("_cell.*")


def profile_nulls(raw: DataFrame) -> DataFrame:
    """Missing values per sheet and column."""
    return null_report(raw, SHEET, RAW_COLUMNS)


def profile_numbers(raw: DataFrame) -> DataFrame:
    """Numeric summary per sheet."""
    return numeric_summary(raw, SHEET, ["Quantity", "Price", "Customer ID"])


def profile_sample(raw: DataFrame, sheets: list[str], n: int = 5) -> DataFrame:
    """First lines of every sheet by date and invoice."""
    order = _line_order(F.col("InvoiceDate").asc_nulls_last())
    return top_of_each(raw, "SourceYear", sheets, order, n).withColumn("Price", number("Price"))


# ---- transaction audit -------------------------------------------------------


def transaction_audit(raw: DataFrame) -> DataFrame:
    """Signs, cancellations, values and coverage per sheet in long form."""
    quantity, price, value = F.col("Quantity"), F.col("Price"), F.col("Quantity") * F.col("Price")
    cancelled = starts_with(F.col("Invoice"), "C")
    identified = F.col("Customer ID").isNotNull()
    metrics = {
        "total_rows": F.count("*"),
        "negative_quantity_rows": F.count_if(quantity < 0),
        "zero_quantity_rows": F.count_if(quantity == 0),
        "positive_quantity_rows": F.count_if(quantity > 0),
        "negative_price_rows": F.count_if(price < 0),
        "zero_price_rows": F.count_if(price == 0),
        "positive_price_rows": F.count_if(price > 0),
        "cancellation_rows": F.count_if(cancelled),
        "normal_rows": F.count_if(~cancelled),
        "gross_value": F.sum(value),
        "positive_quantity_value": F.sum(F.when(quantity > 0, value).otherwise(0)),
        "negative_quantity_value": F.sum(F.when(quantity < 0, value).otherwise(0)),
        "negative_price_value": F.sum(F.when(price < 0, value).otherwise(0)),
        "rows_with_customer": F.count_if(identified),
        "rows_without_customer": F.count_if(~identified),
        "customer_coverage_pct": F.round(F.avg(identified.cast("double")) * 100, 2),
        "countries": F.countDistinct("Country"),
    }
    return to_long(raw.groupBy(*SHEET).agg(*[m.alias(n) for n, m in metrics.items()]), SHEET, {n: F.col(n) for n in metrics})


def _lines(raw: DataFrame, sheets: list[str], order, n: int) -> DataFrame:
    return (
        top_of_each(raw, "SourceYear", sheets, order, n)
        .select("SourceYear", "position", *_LINE)
        .withColumn("Price", number("Price"))
    )


def cancellation_examples(raw: DataFrame, sheets: list[str], n: int = 10) -> DataFrame:
    """First cancellation lines per sheet."""
    return _lines(
        raw.filter(starts_with(F.col("Invoice"), "C")), sheets, _line_order(F.col("InvoiceDate").asc_nulls_last()), n
    )


def most_negative_quantities(raw: DataFrame, sheets: list[str], n: int = 10) -> DataFrame:
    """Lines with the most negative quantity per sheet."""
    return _lines(raw.filter("Quantity < 0"), sheets, _line_order(F.col("Quantity").asc()), n)


def most_negative_prices(raw: DataFrame, sheets: list[str], n: int = 10) -> DataFrame:
    """Lines with the most negative price per sheet."""
    return _lines(raw.filter("Price < 0"), sheets, _line_order(F.col("Price").asc()), n)


def top_countries_by_rows(raw: DataFrame, n: int = 10) -> DataFrame:
    """Countries with the most lines per sheet."""
    counted = raw.filter(F.col("Country").isNotNull()).groupBy(*SHEET, "Country").agg(F.count("*").alias("rows"))
    return top_per_group(counted, "SourceYear", [F.desc("rows"), F.asc("Country")], n)


# ---- business profile --------------------------------------------------------


def business_scale(raw: DataFrame) -> DataFrame:
    """Rows, distinct entities, date range and customer coverage per sheet."""
    identified = F.col("Customer ID").isNotNull()
    distinct = {
        "unique_invoices": "Invoice",
        "unique_products": "StockCode",
        "unique_customers": "Customer ID",
        "unique_countries": "Country",
    }
    sums = raw.groupBy(*SHEET).agg(
        F.count("*").alias("rows"),
        F.min("InvoiceDate").alias("first_date"),
        F.max("InvoiceDate").alias("last_date"),
        F.count_if(identified).alias("rows_with_customer"),
        F.count_if(~identified).alias("rows_without_customer"),
        F.round(F.avg(identified.cast("double")) * 100, 2).alias("customer_coverage_pct"),
    )
    return with_distinct(sums, raw, SHEET, distinct)


def business_types(raw: DataFrame) -> DataFrame:
    """Rows, invoices, value and row share per sheet and audit type."""
    per_invoice = (
        classify_audit(raw)
        .groupBy(*SHEET, "TransactionType", "Invoice")
        .agg(F.count("*").alias("_rows"), F.sum("LineRevenue").alias("_value"))
    )
    grouped = per_invoice.groupBy(*SHEET, "TransactionType").agg(
        F.sum("_rows").alias("rows"), F.count("Invoice").alias("unique_invoices"), number(F.sum("_value")).alias("revenue")
    )
    sheets = raw.groupBy(*SHEET).agg(F.count("*").alias("_all"))
    return (
        grouped.join(sheets, SHEET)
        .withColumn("row_pct", F.round(F.col("rows").cast("double") / F.col("_all") * 100, 2))
        .drop("_all")
    )


def top_sales(raw: DataFrame, column: str, n: int = 15) -> DataFrame:
    """Products, countries or customers with the highest sales per sheet."""
    summed = (
        classify_audit(raw)
        .filter((F.col("TransactionType") == C.SALE) & F.col(f"`{column}`").isNotNull())
        .groupBy(*SHEET, F.col(f"`{column}`"))
        .agg(F.sum("LineRevenue").alias("revenue"))
    )
    ranked = top_per_group(summed, "SourceYear", [F.desc("revenue"), F.col(f"`{column}`").asc()], n)
    return ranked.withColumn("revenue", number("revenue"))


# ---- clean table -------------------------------------------------------------

_TYPES = {name: f"type__{place}" for place, name in enumerate(C.CLEAN_TYPES)}


def clean_measures() -> list[Column]:
    """What is observed of the clean table while it is written: counts, sums and dates that need no other scan."""
    eligible, returned = F.col("IsRevenueEligible"), F.col("IsReturn")
    accounting = F.col("TransactionType") == C.ACCOUNTING
    quantity, price, value = F.col("Quantity"), F.col("UnitPrice"), F.col("LineRevenue")
    checks = {
        ("rows", "rows"): F.count("*"),
        ("revenue_eligibility", "eligible_rows"): F.count_if(eligible),
        ("revenue_eligibility", "invalid_rows"): F.count_if(eligible & ((quantity <= 0) | (price <= 0))),
        ("returns", "return_rows"): F.count_if(returned),
        ("returns", "invalid_rows"): F.count_if(returned & (quantity >= 0)),
        ("accounting", "rows"): F.count_if(accounting),
        ("accounting", "eligible_rows"): F.count_if(accounting & eligible),
        ("price", "negative"): F.count_if(price < 0),
        ("price", "zero"): F.count_if(price == 0),
        ("price", "positive"): F.count_if(price > 0),
        ("quantity", "negative"): F.count_if(quantity < 0),
        ("quantity", "zero"): F.count_if(quantity == 0),
        ("quantity", "positive"): F.count_if(quantity > 0),
        ("customer", "present"): F.count("CustomerID"),
        ("customer", "missing"): F.count_if(F.col("CustomerID").isNull()),
        ("date", "missing"): F.count_if(F.col("InvoiceDate").isNull()),
        ("date", "minimum"): F.min("InvoiceDate"),
        ("date", "maximum"): F.max("InvoiceDate"),
        ("financial", "gross_sales"): F.sum(F.when(eligible, value).otherwise(0)),
        ("financial", "return_value"): F.sum(F.when(returned, value).otherwise(0)),
    }
    measures = {"__".join(key): measure for key, measure in checks.items()}
    measures |= {column: F.count_if(F.col("TransactionType") == name) for name, column in _TYPES.items()}
    return [measure.alias(name) for name, measure in measures.items()]


def _type_rows(observed: DataFrame) -> DataFrame:
    """(TransactionType, rows) of the types that occur."""
    cells = F.array(*[F.struct(F.lit(name).alias("TransactionType"), F.col(column).alias("rows")) for name, column in _TYPES.items()])
    return observed.select(F.explode(cells).alias("_cell")).select("_cell.*").filter("rows > 0")


def clean_type_counts(observed: DataFrame) -> DataFrame:
    """Clean rows per transaction type, as observed."""
    return _type_rows(observed)


def clean_totals(observed: DataFrame) -> DataFrame:
    """Clean rows, eligible rows, identified rows and date range, as observed."""
    return observed.select(
        F.col("rows__rows").alias("rows"),
        F.col("revenue_eligibility__eligible_rows").alias("revenue_eligible_rows"),
        F.col("customer__present").alias("customer_identified_rows"),
        F.col("date__minimum").alias("first_date"),
        F.col("date__maximum").alias("last_date"),
    )


def validate_clean(observed: DataFrame, tx: DataFrame, repeated: DataFrame) -> DataFrame:
    """Invariant counts and totals of the clean table as (check, metric, value, text) rows.

    `observed` holds what was seen while the table was written. The table itself is read for two checks
    alone: its distinct customers, and duplicates among the lines whose hash was `repeated` before cleaning.
    """
    empty_text, empty_value = F.lit(None).cast("string"), F.lit(None).cast("double")

    def cell(check: str, metric: str, value: Column, text: Column = empty_text) -> Column:
        return F.struct(
            F.lit(check).alias("check"), F.lit(metric).alias("metric"), value.cast("double").alias("value"), text.alias("text")
        )

    dates = ["date__minimum", "date__maximum"]
    names = [name for name in observed.columns if name not in [*dates, *_TYPES.values()]]
    cells = [cell(*name.split("__"), F.col(name)) for name in names]
    cells += [cell(*name.split("__"), empty_value, F.col(name).cast("string")) for name in dates]
    cells.append(cell("financial", "net_value", F.col("financial__gross_sales") + F.col("financial__return_value")))
    cells.append(cell("customer", "unique", tx.agg(F.countDistinct("CustomerID")).scalar()))
    cells.append(cell("duplicates", "rows", count_copies(tx, repeated, CLEAN_BASE).scalar()))
    measured = observed.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")
    types = _type_rows(observed).select(
        F.lit("transaction_type").alias("check"),
        F.col("TransactionType").alias("metric"),
        F.col("rows").cast("double").alias("value"),
        empty_text.alias("text"),
    )
    return measured.unionByName(types)
