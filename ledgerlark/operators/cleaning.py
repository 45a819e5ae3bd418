"""From raw invoice lines to the clean transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.labels import audit_type, clean_type
from ledgerlark.functions.text import starts_with, strip
from ledgerlark.operators.bit_filter import BitFilter
from ledgerlark.operators.profile import row_hash
from ledgerlark.schema import CLEAN_COLUMNS, CLEAN_NAMES, PRICE


def standardize(raw: DataFrame) -> DataFrame:
    """Raw column names to clean ones."""
    return raw.withColumnsRenamed(CLEAN_NAMES)


def deduplicate(df: DataFrame, repeated: DataFrame) -> DataFrame:
    """Exact duplicates removed over all columns; `repeated` is `repeated_hashes` of these columns, as a stage table.

    A row whose hash occurs once is kept where it is. Only rows whose hash may occur again are shuffled
    and compared in full, after copies were dropped in each task, so a line that is repeated many times
    never gathers in one. Identical lines of two yearly sheets differ in `SourceYear` and both stay.
    """
    suspect = BitFilter(repeated, "hash").may_hold(row_hash(df.columns))
    return df.where(~suspect).unionByName(df.where(suspect).distinct())


def classify_clean(df: DataFrame) -> DataFrame:
    """Invoice prefix, cancellation and accounting marks, line value and transaction type."""
    invoice = strip(F.col("InvoiceNo"))
    return df.withColumns(
        {
            "InvoicePrefix": F.substring(invoice, 1, 1),
            "IsCancellation": starts_with(invoice, "C"),
            "IsAccountingAdjustment": starts_with(invoice, "A"),
            "LineRevenue": (F.col("Quantity") * F.col("UnitPrice")).cast(PRICE),
            "TransactionType": clean_type(F.col("InvoiceNo"), F.col("Quantity"), F.col("UnitPrice")),
        }
    )


def classify_audit(raw: DataFrame) -> DataFrame:
    """Line value and audit transaction type of raw lines."""
    return raw.withColumns(
        {
            "InvoicePrefix": F.substring("Invoice", 1, 1),
            "LineRevenue": (F.col("Quantity") * F.col("Price")).cast(PRICE),
            "TransactionType": audit_type(F.col("Invoice"), F.col("Quantity"), F.col("Price")),
        }
    )


def add_flags(df: DataFrame) -> DataFrame:
    """Analytical flags. Revenue-eligible lines are the commercial sales."""
    sale = F.col("TransactionType") == C.SALE
    return df.withColumns(
        {
            "IsCustomerIdentified": F.col("CustomerID").isNotNull(),
            "IsCommercialSale": sale,
            "IsReturn": F.col("TransactionType") == C.RETURN,
            "IsRevenueEligible": sale,
        }
    )


def drop_other(df: DataFrame) -> DataFrame:
    """Rows that stand for a meaningful transaction."""
    return df.filter(F.col("TransactionType") != C.OTHER)


def clean_transactions(raw: DataFrame, repeated: DataFrame) -> DataFrame:
    """Clean transaction table of raw invoice lines; `repeated` is `repeated_hashes` of them.

    All added columns depend on the raw ones alone, so the duplicates are taken
    out first, over nine columns instead of eighteen.
    """
    lines = deduplicate(standardize(raw), repeated)
    return drop_other(add_flags(classify_clean(lines))).select(*CLEAN_COLUMNS)
