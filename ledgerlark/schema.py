"""Fixed schemas. Nothing is inferred at read time."""

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)

RAW = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("Price", PRICE),
        T.StructField("Customer ID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)

# Raw names on the left, clean names on the right.
CLEAN_NAMES = {"Invoice": "InvoiceNo", "Price": "UnitPrice", "Customer ID": "CustomerID"}

CLEAN_BASE = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID",
    "Country", "SourceYear",
]

CLEAN_COLUMNS = [
    *CLEAN_BASE, "InvoicePrefix", "IsCancellation", "IsAccountingAdjustment", "LineRevenue",
    "TransactionType", "IsCustomerIdentified", "IsCommercialSale", "IsReturn", "IsRevenueEligible",
]
