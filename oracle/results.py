"""SQL of the named results over the subqueries of `oracle.tables`."""

from ledgerlark import constants as C
from ledgerlark.catalog import STAR_SETTINGS as S
from oracle.tables import texts

RESULTS: dict[str, str] = {}

SALE = "CASE WHEN IsRevenueEligible THEN {} ELSE 0 END"
RET = "CASE WHEN IsReturn THEN {} ELSE 0 END"
GROSS = f"sum({SALE.format('LineRevenue')})"
BACK = f"sum({RET.format('LineRevenue')})"
UNITS = f"sum({SALE.format('Quantity')})::BIGINT"
SALE_ORDERS = "count(DISTINCT CASE WHEN IsRevenueEligible THEN InvoiceNo END)"


def doubles(columns: str) -> str:
    """REPLACE list that turns the named columns into doubles."""
    return "REPLACE (" + ", ".join(f"{c}::DOUBLE AS {c}" for c in columns.split()) + ")"


def shares(table: str, value: str, key: str, rule: str, suffix: str) -> str:
    """Top shares with a plain window."""
    def size(p):
        return f"ceil(n * {p} / 100.0::DECIMAL(18,4))" if rule == "ceil" else f"greatest(1, n * {p} // 100)"

    columns = ", ".join(
        f"round(100.0::DOUBLE * sum(CASE WHEN k <= {size(p)} THEN {value} ELSE 0 END)::DOUBLE / sum({value})::DOUBLE, 2)"
        f" AS top_{p}{suffix}"
        for p in C.TOP_PERCENTS
    )
    return f"""SELECT {columns} FROM (SELECT {value}, row_number() OVER (ORDER BY {value} DESC, {key}) AS k,
      count(*) OVER () AS n FROM {table})"""


def labels(table: str, columns: list[str], count: str = "products") -> str:
    """Frequencies of several label columns."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS label, {c}::VARCHAR AS value, count(*) AS {count} FROM {table} GROUP BY {c}" for c in columns
    )


# ---- commercial KPIs ---------------------------------------------------------

RESULTS["q1_data_quality"] = """
SELECT count(*) AS total_transaction_rows, count(DISTINCT InvoiceNo) AS unique_invoices,
  count(DISTINCT StockCode) AS unique_products, count(DISTINCT CustomerID) AS identified_customers,
  count(DISTINCT Country) AS countries FROM x_tx"""
RESULTS["q1_revenue_kpis"] = f"""
SELECT round({GROSS}, 2)::DOUBLE AS gross_sales_revenue, round({BACK}, 2)::DOUBLE AS return_value,
  round({GROSS} + {BACK}, 2)::DOUBLE AS net_commercial_value FROM x_tx"""
RESULTS["q1_monthly_trend"] = f"""
SELECT date_trunc('month', InvoiceDate) AS sales_month, round({GROSS}, 2)::DOUBLE AS gross_revenue,
  round({BACK}, 2)::DOUBLE AS return_value, round(sum(LineRevenue), 2)::DOUBLE AS net_revenue,
  count(DISTINCT InvoiceNo) AS orders FROM x_tx WHERE InvoiceDate IS NOT NULL GROUP BY 1"""
RESULTS["q1_country"] = f"""
SELECT Country, count(DISTINCT InvoiceNo) AS orders, count(DISTINCT CustomerID) AS customers, {UNITS} AS units_sold,
  round({GROSS}, 2)::DOUBLE AS gross_revenue, round(sum(LineRevenue), 2)::DOUBLE AS net_revenue
FROM x_tx GROUP BY Country"""
RESULTS["q1_top_products"] = f"""
SELECT StockCode, max(Description) AS Description, {UNITS} AS units_sold, {SALE_ORDERS} AS orders,
  round({GROSS}, 2)::DOUBLE AS gross_revenue, round(sum(LineRevenue), 2)::DOUBLE AS net_revenue
FROM x_tx GROUP BY StockCode ORDER BY net_revenue DESC, StockCode LIMIT 50"""
RESULTS["q1_top_customers"] = f"""
SELECT CustomerID, {SALE_ORDERS} AS orders, {UNITS} AS units, round({GROSS}, 2)::DOUBLE AS gross_revenue,
  round(sum(LineRevenue), 2)::DOUBLE AS net_revenue
FROM x_tx WHERE CustomerID IS NOT NULL GROUP BY CustomerID ORDER BY net_revenue DESC, CustomerID LIMIT 50"""
RESULTS["q1_customer_concentration"] = shares("x_cust", "NetAll", "CustomerID", "ceil", "pct_revenue_share")
RESULTS["q1_return_risk_customer"] = f"""
SELECT CustomerID, {SALE_ORDERS} AS sales_orders,
  count(DISTINCT CASE WHEN IsReturn THEN InvoiceNo END) AS return_orders, round({GROSS}, 2)::DOUBLE AS gross_sales,
  round({BACK}, 2)::DOUBLE AS return_value, round(sum(LineRevenue), 2)::DOUBLE AS net_revenue
FROM x_tx WHERE CustomerID IS NOT NULL GROUP BY CustomerID HAVING round({GROSS}, 2) > 0"""
RESULTS["q1_type_distribution"] = """
SELECT TransactionType, count(*) AS transaction_rows, count(DISTINCT InvoiceNo) AS invoices,
  round(sum(LineRevenue), 2)::DOUBLE AS transaction_value FROM x_tx GROUP BY TransactionType"""

# ---- products over the taxonomy ------------------------------------------------

MERCH = "x_tx t JOIN x_tax p ON t.StockCode = p.StockCode AND p.ProductCategory = 'Merchandise'"

RESULTS["q2_top_merchandise"] = f"""
SELECT t.StockCode, max(t.Description) AS Description, max(p.ProductCategory) AS ProductCategory, {UNITS} AS units_sold,
  {SALE_ORDERS} AS orders, round({GROSS}, 2)::DOUBLE AS gross_revenue, round(sum(LineRevenue), 2)::DOUBLE AS net_revenue,
  round(sum(CASE WHEN IsRevenueEligible THEN UnitPrice END)::DOUBLE / count(CASE WHEN IsRevenueEligible THEN UnitPrice END), 2)
    AS average_unit_price
FROM {MERCH} GROUP BY t.StockCode HAVING round({GROSS}, 2) > 0 ORDER BY net_revenue DESC, t.StockCode LIMIT 50"""
RESULTS["q2_merch_concentration"] = shares(
    f"(SELECT t.StockCode, {GROSS} AS revenue FROM {MERCH} GROUP BY t.StockCode)", "revenue", "StockCode", "ceil",
    "pct_revenue_share",
)
RESULTS["q2_product_return_risk"] = f"""
SELECT t.StockCode, max(t.Description) AS Description, round({GROSS}, 2)::DOUBLE AS gross_revenue,
  round({BACK}, 2)::DOUBLE AS return_value,
  round(100.0::DOUBLE * abs({BACK})::DOUBLE / nullif({GROSS}::DOUBLE, 0), 2) AS return_value_rate,
  {UNITS} AS units_sold, abs(sum({RET.format("Quantity")}))::BIGINT AS returned_units
FROM {MERCH} GROUP BY t.StockCode HAVING round({GROSS}, 2) > 0 ORDER BY return_value_rate DESC, t.StockCode LIMIT 50"""
RESULTS["q2_category_performance"] = f"""
SELECT p.ProductCategory, count(DISTINCT t.StockCode) AS products, {UNITS} AS units_sold,
  round({GROSS}, 2)::DOUBLE AS gross_revenue, round(sum(LineRevenue), 2)::DOUBLE AS net_revenue
FROM x_tx t JOIN x_tax p ON t.StockCode = p.StockCode GROUP BY p.ProductCategory"""
RESULTS["q2_monthly_merch"] = f"""
SELECT date_trunc('month', t.InvoiceDate) AS sales_month, round({GROSS}, 2)::DOUBLE AS merchandise_revenue,
  {UNITS} AS units_sold FROM {MERCH} WHERE t.InvoiceDate IS NOT NULL GROUP BY 1"""

# ---- customers -----------------------------------------------------------------

RESULTS["q3_customer_value"] = f"""
SELECT CustomerID, {SALE_ORDERS} AS orders, {GROSS}::DOUBLE AS gross_revenue, {BACK}::DOUBLE AS return_value,
  round(sum(LineRevenue), 2)::DOUBLE AS net_revenue, {UNITS} AS units_sold,
  round({GROSS}::DOUBLE / nullif({SALE_ORDERS}, 0), 2) AS average_order_value
FROM x_tx WHERE CustomerID IS NOT NULL GROUP BY CustomerID HAVING {GROSS} > 0
ORDER BY net_revenue DESC, CustomerID LIMIT 50"""
RESULTS["q3_customer_concentration"] = shares(
    "(SELECT CustomerID, Gross + Ret AS net FROM x_cust WHERE Gross + Ret > 0)", "net", "CustomerID", "ceil",
    "pct_revenue_share",
)
_SEGMENTS = """
SELECT Segment, count(*) AS customers, round(sum(Monetary), 2)::DOUBLE AS gross_revenue,
  round(sum(Monetary)::DOUBLE / count(*), 2) AS average_customer_value,
  round(sum(Frequency)::DOUBLE / count(*), 2) AS average_orders,
  round(sum(Recency)::DOUBLE / count(*), 1) AS average_recency_days FROM x_rfm GROUP BY Segment"""
RESULTS["q3_rfm_segments"] = _SEGMENTS
RESULTS["q3_at_risk_customers"] = """
SELECT CustomerID, Segment, Recency, Frequency, round(Monetary, 2)::DOUBLE AS gross_revenue,
  round(Monetary::DOUBLE / nullif(Frequency, 0), 2) AS revenue_per_order
FROM x_rfm WHERE Segment = 'At Risk High Value' ORDER BY Monetary DESC, CustomerID LIMIT 50"""
RESULTS["q3_return_risk_customer"] = f"""
SELECT CustomerID, {SALE_ORDERS} AS sales_orders,
  count(DISTINCT CASE WHEN IsReturn THEN InvoiceNo END) AS return_orders, round({GROSS}, 2)::DOUBLE AS gross_revenue,
  round(abs({BACK}), 2)::DOUBLE AS return_value,
  round(100.0::DOUBLE * abs({BACK})::DOUBLE / nullif({GROSS}::DOUBLE, 0), 2) AS return_value_rate
FROM x_tx WHERE CustomerID IS NOT NULL GROUP BY CustomerID HAVING round({GROSS}, 2) > 0
ORDER BY return_value_rate DESC, CustomerID LIMIT 50"""
RESULTS["q3_value_quartiles"] = """
SELECT value_quartile, count(*) AS customers, round(sum(net), 2)::DOUBLE AS net_revenue,
  round(sum(net)::DOUBLE / count(*), 2) AS average_customer_value
FROM (SELECT net, ntile(4) OVER (ORDER BY net, CustomerID)::BIGINT AS value_quartile
      FROM (SELECT CustomerID, Gross + Ret AS net FROM x_cust WHERE Gross + Ret > 0)) GROUP BY value_quartile"""
_REPEAT = """
SELECT count(*) AS identified_customers, sum(CASE WHEN orders = 1 THEN 1 ELSE 0 END)::BIGINT AS one_time_customers,
  sum(CASE WHEN orders >= 2 THEN 1 ELSE 0 END)::BIGINT AS repeat_customers,
  round(100.0::DOUBLE * sum(CASE WHEN orders >= 2 THEN 1 ELSE 0 END) / count(*), 2) AS repeat_customer_rate
FROM (SELECT CustomerID, count(DISTINCT CASE WHEN IsRevenueEligible THEN InvoiceNo END) AS orders
      FROM x_tx WHERE CustomerID IS NOT NULL GROUP BY CustomerID)"""
RESULTS["q3_repeat_purchase"] = _REPEAT
RESULTS["q3_value_x_return_risk"] = f"""
SELECT CASE WHEN Gross >= {S.high_value_customer} THEN 'High Value' ELSE 'Standard Value' END AS value_class,
  CASE WHEN abs(Ret)::DOUBLE / Gross::DOUBLE >= 0.30 THEN 'High Return Risk'
       WHEN abs(Ret)::DOUBLE / Gross::DOUBLE >= 0.15 THEN 'Moderate Return Risk' ELSE 'Low Return Risk' END AS return_risk_class,
  count(*) AS customers, round(sum(Gross + Ret), 2)::DOUBLE AS net_revenue
FROM x_cust WHERE Gross > 0 GROUP BY 1, 2"""

# ---- executive -----------------------------------------------------------------

_NET = f"({GROSS} + {BACK})"
RESULTS["q4_exec_kpis"] = f"""
SELECT count(*) AS transaction_rows, count(DISTINCT InvoiceNo) AS total_orders,
  count(DISTINCT CASE WHEN IsCustomerIdentified THEN CustomerID END) AS identified_customers,
  count(DISTINCT StockCode) AS product_records, count(DISTINCT Country) AS countries,
  round({GROSS}, 2)::DOUBLE AS gross_revenue, round({BACK}, 2)::DOUBLE AS return_value,
  round({_NET}, 2)::DOUBLE AS net_revenue, {UNITS} AS units_sold,
  round({_NET}::DOUBLE / nullif({SALE_ORDERS}, 0), 2) AS net_revenue_per_order FROM x_tx"""
RESULTS["q4_customer_health"] = """
SELECT count(*) AS customers, round(sum(Gross + Ret)::DOUBLE / count(*), 2) AS avg_customer_value,
  round(sum(Gross + Ret)::DOUBLE / count(*), 2) AS revenue_per_customer,
  round(sum(SalesOrders)::DOUBLE / count(*), 2) AS average_orders_per_customer,
  round(sum(CASE WHEN SalesOrders > 1 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 2) AS repeat_customer_rate,
  round(sum(CASE WHEN Ret < 0 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 2) AS customers_with_returns
FROM x_cust"""
RESULTS["q4_customer_concentration"] = shares(
    "(SELECT CustomerID, Gross + Ret AS net FROM x_cust)", "net", "CustomerID", "ceil", "pct_share"
)
RESULTS["q4_monthly_net"] = f"""
SELECT date_trunc('month', InvoiceDate) AS month, round({_NET}, 2)::DOUBLE AS net_revenue, {SALE_ORDERS} AS orders,
  {UNITS} AS units_sold FROM x_tx GROUP BY 1"""
RESULTS["q4_country"] = f"""
SELECT Country, round({_NET}, 2)::DOUBLE AS net_revenue, {SALE_ORDERS} AS orders,
  count(DISTINCT CASE WHEN IsCustomerIdentified THEN CustomerID END) AS customers,
  round({_NET}::DOUBLE / nullif({SALE_ORDERS}, 0), 2) AS revenue_per_order FROM x_tx GROUP BY Country"""
RESULTS["q4_rfm_segments"] = _SEGMENTS
RESULTS["q4_recovery_opportunity"] = """
SELECT count(*) AS high_value_at_risk_customers, round(sum(Monetary), 2)::DOUBLE AS recoverable_gross_revenue,
  round(sum(Monetary)::DOUBLE / count(*), 2) AS average_customer_value,
  round(sum(Recency)::DOUBLE / count(*), 1) AS average_days_since_purchase,
  round(sum(Frequency)::DOUBLE / count(*), 2) AS average_historical_orders
FROM x_rfm WHERE Segment = 'At Risk High Value'"""
RESULTS["q4_repeat_purchase"] = _REPEAT
RESULTS["q4_opportunity_matrix"] = f"""
SELECT CASE WHEN net >= {S.opportunity_value} THEN 'High Value' ELSE 'Standard Value' END AS value_class,
  count(*) AS customers, round(sum(net), 2)::DOUBLE AS net_revenue,
  round(sum(net)::DOUBLE / count(*), 2) AS average_customer_value
FROM (SELECT Gross + Ret AS net FROM x_cust) GROUP BY 1"""

# ---- raw audits ----------------------------------------------------------------

_RAW = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
_COLUMNS = ", ".join(f'"{c}"' for c in _RAW)
_ORDER = 'Invoice, StockCode, Description, Quantity, Price, InvoiceDate, "Customer ID" NULLS LAST'

RESULTS["audit_profile"] = f"""
SELECT SourceYear, sum(copies)::BIGINT AS rows, sum(copies - 1)::BIGINT AS duplicate_rows, 8::BIGINT AS columns
FROM (SELECT SourceYear, {_COLUMNS}, count(*) AS copies FROM x_raw GROUP BY ALL) GROUP BY SourceYear"""
_KINDS = ["string", "string", "string", "bigint", "timestamp_ntz", "decimal(18,4)", "bigint", "string"]
RESULTS["audit_profile_types"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS type, count(\"{c}\") AS non_null FROM x_raw" for c, k in zip(_RAW, _KINDS)
)
RESULTS["audit_profile_nulls"] = (
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT SourceYear, '{c}' AS "column", count(*) FILTER ("{c}" IS NULL) AS missing_count,
        round((count(*) FILTER ("{c}" IS NULL))::DOUBLE / count(*) * 100, 2) AS missing_pct FROM x_raw GROUP BY SourceYear"""
        for c in _RAW
    )
    + ") WHERE missing_count > 0"
)
RESULTS["audit_profile_numbers"] = " UNION ALL ".join(
    f"""SELECT SourceYear, '{c}' AS "column", count("{c}") AS count, round(avg("{c}"::DOUBLE), 6) AS mean,
    round(stddev_samp("{c}"::DOUBLE), 6) AS std, min("{c}")::DOUBLE AS min, max("{c}")::DOUBLE AS max,
    quantile_cont("{c}"::DOUBLE, 0.25) AS q25, quantile_cont("{c}"::DOUBLE, 0.5) AS q50, quantile_cont("{c}"::DOUBLE, 0.75) AS q75
    FROM x_raw GROUP BY SourceYear"""
    for c in ["Quantity", "Price", "Customer ID"]
)
RESULTS["audit_profile_sample"] = f"""
SELECT * REPLACE (Price::DOUBLE AS Price) FROM (
  SELECT *, row_number() OVER (PARTITION BY SourceYear ORDER BY InvoiceDate, {_ORDER}) AS position FROM x_raw)
WHERE position <= 5"""

_VALUE = "Quantity * Price"
_AUDIT = {
    "total_rows": "count(*)",
    "negative_quantity_rows": "count(*) FILTER (Quantity < 0)",
    "zero_quantity_rows": "count(*) FILTER (Quantity = 0)",
    "positive_quantity_rows": "count(*) FILTER (Quantity > 0)",
    "negative_price_rows": "count(*) FILTER (Price < 0)",
    "zero_price_rows": "count(*) FILTER (Price = 0)",
    "positive_price_rows": "count(*) FILTER (Price > 0)",
    "cancellation_rows": "count(*) FILTER (Invoice LIKE 'C%')",
    "normal_rows": "count(*) FILTER (Invoice NOT LIKE 'C%')",
    "gross_value": f"sum({_VALUE})",
    "positive_quantity_value": f"coalesce(sum({_VALUE}) FILTER (Quantity > 0), 0)",
    "negative_quantity_value": f"coalesce(sum({_VALUE}) FILTER (Quantity < 0), 0)",
    "negative_price_value": f"coalesce(sum({_VALUE}) FILTER (Price < 0), 0)",
    "rows_with_customer": 'count("Customer ID")',
    "rows_without_customer": 'count(*) - count("Customer ID")',
    "customer_coverage_pct": 'round(count("Customer ID")::DOUBLE / count(*) * 100, 2)',
    "countries": "count(DISTINCT Country)",
}
RESULTS["audit_transactions"] = " UNION ALL ".join(
    f"SELECT SourceYear, '{name}' AS metric, ({sql})::DOUBLE AS value FROM x_raw GROUP BY SourceYear"
    for name, sql in _AUDIT.items()
)


def _lines(where: str, first: str) -> str:
    return f"""SELECT SourceYear, position, Invoice, StockCode, Description, Quantity, Price::DOUBLE AS Price FROM (
      SELECT *, row_number() OVER (PARTITION BY SourceYear ORDER BY {first}, {_ORDER}) AS position FROM x_raw WHERE {where})
    WHERE position <= 10"""


RESULTS["audit_cancellation_examples"] = _lines("Invoice LIKE 'C%'", "InvoiceDate")
RESULTS["audit_negative_quantities"] = _lines("Quantity < 0", "Quantity")
RESULTS["audit_negative_prices"] = _lines("Price < 0", "Price")
RESULTS["audit_top_countries"] = """
SELECT * FROM (SELECT SourceYear, Country, count(*) AS rows,
    row_number() OVER (PARTITION BY SourceYear ORDER BY count(*) DESC, Country) AS position
  FROM x_raw GROUP BY SourceYear, Country) WHERE position <= 10"""
RESULTS["audit_business_profile"] = """
SELECT SourceYear, count(*) AS rows, count(DISTINCT Invoice) AS unique_invoices, count(DISTINCT StockCode) AS unique_products,
  count(DISTINCT "Customer ID") AS unique_customers, count(DISTINCT Country) AS unique_countries,
  min(InvoiceDate) AS first_date, max(InvoiceDate) AS last_date, count("Customer ID") AS rows_with_customer,
  count(*) - count("Customer ID") AS rows_without_customer,
  round(count("Customer ID")::DOUBLE / count(*) * 100, 2) AS customer_coverage_pct FROM x_raw GROUP BY SourceYear"""
_AUDIT_TYPE = f"""(SELECT *, (Quantity * Price)::DECIMAL(18,4) AS v,
  CASE WHEN Invoice LIKE 'A%' THEN '{C.ACCOUNTING}' WHEN Invoice LIKE 'C%' AND Quantity < 0 THEN '{C.RETURN}'
    WHEN Quantity < 0 AND Price = 0 THEN '{C.OPERATIONAL}' WHEN Quantity > 0 AND Price = 0 THEN '{C.ZERO_PRICE}'
    WHEN Quantity > 0 AND Price > 0 THEN '{C.SALE}' WHEN Price < 0 THEN '{C.NEGATIVE_PRICE}' ELSE '{C.OTHER}' END
    AS TransactionType FROM x_raw)"""
RESULTS["audit_business_types"] = f"""
SELECT SourceYear, TransactionType, count(*) AS rows, count(DISTINCT Invoice) AS unique_invoices,
  sum(v)::DOUBLE AS revenue,
  round(count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY SourceYear))::DOUBLE * 100, 2) AS row_pct
FROM {_AUDIT_TYPE} GROUP BY SourceYear, TransactionType"""
for _name, _column in [("products", "StockCode"), ("countries", "Country"), ("customers", "Customer ID")]:
    RESULTS[f"audit_business_{_name}"] = f"""
SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM (SELECT SourceYear, "{_column}", sum(v) AS revenue,
    row_number() OVER (PARTITION BY SourceYear ORDER BY sum(v) DESC, "{_column}") AS position
  FROM {_AUDIT_TYPE} WHERE TransactionType = '{C.SALE}' AND "{_column}" IS NOT NULL GROUP BY SourceYear, "{_column}")
WHERE position <= 15"""

# ---- clean table ---------------------------------------------------------------

RESULTS["ingest_csv"] = """
SELECT SourceYear, count(*) AS rows, count(Description) AS described, count("Customer ID") AS identified,
  sum(Quantity)::BIGINT AS units, sum(Quantity * Price)::DOUBLE AS value, min(InvoiceDate) AS first_date,
  max(InvoiceDate) AS last_date FROM x_raw GROUP BY SourceYear"""
RESULTS["clean_transactions"] = f"SELECT * {doubles('UnitPrice LineRevenue')} FROM x_tx"
RESULTS["clean_summary"] = "SELECT TransactionType, count(*) AS rows FROM x_tx GROUP BY TransactionType"
RESULTS["clean_summary_totals"] = """
SELECT count(*) AS rows, count(*) FILTER (IsRevenueEligible) AS revenue_eligible_rows,
  count(*) FILTER (IsCustomerIdentified) AS customer_identified_rows, min(InvoiceDate) AS first_date,
  max(InvoiceDate) AS last_date FROM x_tx"""
_CHECKS = {
    ("rows", "rows"): "count(*)",
    ("duplicates", "rows"): "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM x_tx))",
    ("revenue_eligibility", "eligible_rows"): "count(*) FILTER (IsRevenueEligible)",
    ("revenue_eligibility", "invalid_rows"): "count(*) FILTER (IsRevenueEligible AND (Quantity <= 0 OR UnitPrice <= 0))",
    ("returns", "return_rows"): "count(*) FILTER (IsReturn)",
    ("returns", "invalid_rows"): "count(*) FILTER (IsReturn AND Quantity >= 0)",
    ("accounting", "rows"): f"count(*) FILTER (TransactionType = '{C.ACCOUNTING}')",
    ("accounting", "eligible_rows"): f"count(*) FILTER (TransactionType = '{C.ACCOUNTING}' AND IsRevenueEligible)",
    ("price", "negative"): "count(*) FILTER (UnitPrice < 0)",
    ("price", "zero"): "count(*) FILTER (UnitPrice = 0)",
    ("price", "positive"): "count(*) FILTER (UnitPrice > 0)",
    ("quantity", "negative"): "count(*) FILTER (Quantity < 0)",
    ("quantity", "zero"): "count(*) FILTER (Quantity = 0)",
    ("quantity", "positive"): "count(*) FILTER (Quantity > 0)",
    ("customer", "present"): "count(CustomerID)",
    ("customer", "missing"): "count(*) - count(CustomerID)",
    ("customer", "unique"): "count(DISTINCT CustomerID)",
    ("date", "missing"): "count(*) - count(InvoiceDate)",
    ("financial", "gross_sales"): GROSS,
    ("financial", "return_value"): BACK,
    ("financial", "net_value"): f"{GROSS} + {BACK}",
}
RESULTS["validate_clean"] = " UNION ALL ".join(
    [
        f"SELECT '{check}' AS \"check\", '{metric}' AS metric, ({sql})::DOUBLE AS value, NULL::VARCHAR AS text FROM x_tx"
        for (check, metric), sql in _CHECKS.items()
    ]
    + [
        f"SELECT 'date', '{name}', NULL::DOUBLE, {fn}(InvoiceDate)::VARCHAR FROM x_tx"
        for name, fn in [("minimum", "min"), ("maximum", "max")]
    ]
    + ["SELECT 'transaction_type', TransactionType, count(*)::DOUBLE, NULL::VARCHAR FROM x_tx GROUP BY TransactionType"]
)

# ---- customer stages -----------------------------------------------------------

_RFM = f"SELECT * {doubles('Monetary')} FROM x_rfm"
RESULTS["customer_rfm"] = _RFM
RESULTS["rfm_scope"] = """
SELECT count(*) AS revenue_eligible_rows, count(DISTINCT CustomerID) AS customers,
  (max(InvoiceDate)::DATE + 1)::TIMESTAMP AS observation_date FROM x_tx WHERE IsRevenueEligible AND CustomerID IS NOT NULL"""
RESULTS["rfm_summary"] = "SELECT Segment, count(*) AS customers, sum(Monetary)::DOUBLE AS revenue FROM x_rfm GROUP BY Segment"
RESULTS["rfm_summary_top"] = """
SELECT CustomerID, Recency, Frequency, Monetary::DOUBLE AS Monetary, AverageOrderValue, Segment
FROM x_rfm ORDER BY x_rfm.Monetary DESC, CustomerID LIMIT 15"""
_VALUE_DOUBLES = doubles("GrossRevenue ReturnValue NetRevenue Monetary CumulativeNetRevenue")
RESULTS["customer_value_unnumbered"] = f"SELECT * {_VALUE_DOUBLES} FROM x_value"
RESULTS["customer_value"] = f"SELECT * {_VALUE_DOUBLES} FROM x_value"
RESULTS["customer_value_summary"] = """
SELECT count(*) AS customers, sum(GrossRevenue)::DOUBLE AS gross_revenue, sum(ReturnValue)::DOUBLE AS returns,
  sum(NetRevenue)::DOUBLE AS net_revenue, count(*) FILTER (Segment = 'At Risk High Value') AS at_risk_customers,
  coalesce(sum(NetRevenue) FILTER (Segment = 'At Risk High Value'), 0)::DOUBLE AS at_risk_net_revenue,
  (sum(NetRevenue) FILTER (Segment = 'At Risk High Value'))::DOUBLE
    / nullif(count(*) FILTER (Segment = 'At Risk High Value'), 0) AS at_risk_average FROM x_value"""
RESULTS["customer_value_summary_top"] = """
SELECT RevenueRank, CustomerID, GrossRevenue::DOUBLE AS GrossRevenue, ReturnValue::DOUBLE AS ReturnValue,
  NetRevenue::DOUBLE AS NetRevenue, ReturnValueRate, Segment FROM x_value ORDER BY RevenueRank LIMIT 15"""
RESULTS["customer_value_summary_shares"] = shares("x_value", "NetRevenue", "CustomerID", "floor", "pct_share")
RESULTS["customer_risk"] = f"SELECT * {_VALUE_DOUBLES} FROM x_risk"
RESULTS["customer_risk_summary"] = """
SELECT StrategicClass, count(CustomerID) AS Customers, sum(NetRevenue)::DOUBLE AS NetRevenue,
  sum(GrossRevenue)::DOUBLE AS GrossRevenue, sum(ReturnValue)::DOUBLE AS ReturnValue,
  sum(NetRevenue)::DOUBLE / (SELECT sum(NetRevenue) FROM x_risk)::DOUBLE * 100 AS RevenueShare
FROM x_risk GROUP BY StrategicClass"""
RESULTS["customer_risk_summary_tiers"] = labels("x_risk", ["ValueTier", "ReturnRisk"], "customers")
RESULTS["customer_risk_summary_returns"] = """
SELECT CustomerID, GrossRevenue::DOUBLE AS GrossRevenue, ReturnValue::DOUBLE AS ReturnValue,
  NetRevenue::DOUBLE AS NetRevenue, ReturnValueRate, ValueTier, ReturnRisk, StrategicClass
FROM x_risk ORDER BY x_risk.ReturnValue, CustomerID LIMIT 20"""
_HIGH_RISK = "StrategicClass = 'High Value / High Return Risk'"
RESULTS["customer_risk_summary_high"] = f"""
SELECT CustomerID, NetRevenue::DOUBLE AS NetRevenue, ReturnValue::DOUBLE AS ReturnValue, ReturnValueRate, Segment
FROM x_risk WHERE {_HIGH_RISK} ORDER BY x_risk.NetRevenue DESC, CustomerID LIMIT 20"""
RESULTS["customer_risk_summary_high_totals"] = f"""
SELECT count(*) AS customers, coalesce(sum(NetRevenue), 0)::DOUBLE AS net_revenue FROM x_risk WHERE {_HIGH_RISK}"""
RESULTS["cohort_retention"] = "SELECT * FROM x_cohort"
RESULTS["cohort_summary"] = "SELECT CohortMonth, CohortSize, Revenue FROM x_cohort WHERE CohortIndex = 1"
RESULTS["cohort_summary_weighted"] = """
SELECT CohortIndex, sum(ActiveCustomers)::DOUBLE / sum(CohortSize)::DOUBLE * 100 AS retention
FROM x_cohort WHERE CohortIndex IN (1, 2, 3, 6, 12) GROUP BY CohortIndex"""
for _name, _direction in [("best", "DESC"), ("lowest", "ASC")]:
    RESULTS[f"cohort_summary_{_name}"] = f"""
SELECT CohortMonth, CohortSize, ActiveCustomers, RetentionRate FROM x_cohort WHERE CohortIndex = 3
ORDER BY RetentionRate {_direction}, CohortMonth LIMIT 10"""

# ---- product stages ------------------------------------------------------------

_MONEY = doubles("GrossRevenue ReturnValue NetRevenue")
RESULTS["product_intelligence"] = f"SELECT * {_MONEY} FROM x_intel"
RESULTS["product_intelligence_unnumbered"] = RESULTS["product_intelligence"]
RESULTS["product_intelligence_summary"] = """
SELECT count(*) AS products, sum(GrossRevenue)::DOUBLE AS gross_revenue, sum(ReturnValue)::DOUBLE AS returns,
  sum(NetRevenue)::DOUBLE AS net_revenue FROM x_intel"""
for _name, _columns, _order in [
    ("net", "GrossRevenue ReturnValue NetRevenue UnitsSold ReturnValueRate RevenueShare", "x_intel.NetRevenue DESC"),
    ("units", "UnitsSold GrossRevenue NetRevenue RevenuePerUnit", "UnitsSold DESC"),
    ("returns", "GrossRevenue ReturnValue NetRevenue ReturnValueRate", "x_intel.ReturnValue"),
]:
    _picked = ", ".join(
        f"{c}::DOUBLE AS {c}" if c in ("GrossRevenue", "ReturnValue", "NetRevenue") else c for c in _columns.split()
    )
    RESULTS[f"product_intelligence_top_{_name}"] = (
        f"SELECT StockCode, Description, {_picked} FROM x_intel ORDER BY {_order}, StockCode LIMIT 20"
    )
RESULTS["product_intelligence_shares"] = shares("x_intel", "NetRevenue", "StockCode", "floor", "pct_share")
RESULTS["product_taxonomy"] = f"SELECT * {doubles('GrossRevenue')} FROM x_tax"
RESULTS["taxonomy_summary"] = """
SELECT ProductCategory, count(StockCode) AS Products, sum(GrossRevenue)::DOUBLE AS Revenue, sum(UnitsSold)::BIGINT AS Units,
  sum(GrossRevenue)::DOUBLE / (SELECT sum(GrossRevenue) FROM x_tax)::DOUBLE * 100 AS RevenueShare
FROM x_tax GROUP BY ProductCategory"""
RESULTS["taxonomy_summary_top"] = """
SELECT StockCode, Description, GrossRevenue::DOUBLE AS GrossRevenue, UnitsSold, SalesOrders, RevenueShare
FROM x_tax WHERE CommercialProduct ORDER BY x_tax.GrossRevenue DESC, StockCode LIMIT 20"""
RESULTS["taxonomy_summary_universe"] = """
SELECT count(*) FILTER (CommercialProduct) AS merchandise_products,
  (sum(GrossRevenue) FILTER (CommercialProduct))::DOUBLE AS merchandise_revenue,
  (sum(GrossRevenue) FILTER (CommercialProduct))::DOUBLE / sum(GrossRevenue)::DOUBLE * 100 AS merchandise_share FROM x_tax"""
RESULTS["product_quality"] = f"SELECT * {_MONEY} FROM x_quality"
RESULTS["quality_summary"] = labels("x_quality", ["CommercialValidity", "DescriptionQualityFlag", "StrategicClassification"])
RESULTS["quality_summary_review"] = """
SELECT StockCode, Description, NetRevenue::DOUBLE AS NetRevenue, UnitsSold, DescriptionQualityFlag
FROM x_quality WHERE CommercialValidity = 'Review Required' ORDER BY x_quality.NetRevenue DESC, StockCode LIMIT 15"""
_MASTER = f"SELECT * {_MONEY} FROM x_master"
RESULTS["product_master"] = _MASTER
RESULTS["master_summary"] = labels(
    "x_master", ["ProductMasterStatus", "CommercialPriority", "ReturnRiskFlag", "IncludeInExecutiveAnalytics"]
)
RESULTS["master_summary_top"] = """
SELECT StockCode, Description, NetRevenue::DOUBLE AS NetRevenue, UnitsSold, Orders, ReturnValueRate, CommercialPriority,
  ReturnRiskFlag FROM x_master WHERE IncludeInExecutiveAnalytics ORDER BY x_master.NetRevenue DESC, StockCode LIMIT 20"""
RESULTS["product_scope"] = f"SELECT * {_MONEY} FROM x_scope"
RESULTS["scope_summary"] = labels("x_scope", ["ScopeReason"])
RESULTS["scope_summary_tiers"] = """
SELECT ExecutiveProductTier, count(*) AS products FROM x_scope WHERE IsCommercialMerchandise GROUP BY 1"""
RESULTS["scope_summary_totals"] = """
SELECT count(*) AS products, count(*) FILTER (IsCommercialMerchandise) AS included,
  count(*) FILTER (NOT IsCommercialMerchandise) AS excluded,
  (sum(NetRevenue) FILTER (IsCommercialMerchandise))::DOUBLE AS net_revenue,
  (sum(UnitsSold) FILTER (IsCommercialMerchandise))::BIGINT AS units_sold FROM x_scope"""
RESULTS["scope_summary_top"] = """
SELECT RevenueRank, StockCode, Description, NetRevenue::DOUBLE AS NetRevenue, UnitsSold, Orders, RevenueShare,
  ReturnValueRate, ExecutiveProductTier FROM x_scope WHERE RevenueRank BETWEEN 1 AND 20"""
RESULTS["product_anomalies"] = f"SELECT * {_MONEY} FROM x_anomaly"
_FLAGS = [
    "DescriptionAnomaly", "ReturnAnomaly", "HighRevenueAnomaly", "HighVolumeLowValueAnomaly", "ExtremeRevenuePerOrder",
    "ExtremeRevenuePerUnit",
]
RESULTS["anomaly_summary"] = (
    "SELECT count(*) AS audited, count(*) FILTER (AnomalyScore > 0) AS to_investigate, "
    + ", ".join(f"count(*) FILTER ({f}) AS {f}" for f in _FLAGS)
    + " FROM x_anomaly"
)
RESULTS["anomaly_summary_severity"] = "SELECT AnomalySeverity, count(*) AS products FROM x_anomaly GROUP BY 1"
RESULTS["anomaly_summary_top"] = """
SELECT StockCode, Description, NetRevenue::DOUBLE AS NetRevenue, UnitsSold, Orders, ReturnValueRate, RevenuePerOrder,
  RevenuePerUnit, AnomalyScore, AnomalySeverity, RecommendedAction
FROM x_anomaly WHERE AnomalyScore > 0 ORDER BY AnomalyScore DESC, x_anomaly.NetRevenue DESC, StockCode LIMIT 30"""

# ---- baskets -------------------------------------------------------------------

RESULTS["basket_scope"] = "SELECT InvoiceNo, Item AS StockCode FROM x_basket_code"
RESULTS["basket_scope_totals"] = """
SELECT count(DISTINCT InvoiceNo) AS multi_item_orders, count(DISTINCT Item) AS items, count(*) AS rows FROM x_basket"""
RESULTS["basket_funnel"] = """
SELECT count(*) AS orders, count(*) FILTER (n >= 2) AS multi_item_orders, sum(n * (n - 1) // 2)::BIGINT AS pairs,
  (SELECT count(DISTINCT Item) FROM x_members) AS items, (SELECT count(*) FROM x_assoc) AS associations
FROM (SELECT InvoiceNo, count(*) AS n FROM x_members GROUP BY 1)"""
RESULTS["product_associations"] = "SELECT * FROM x_assoc"
RESULTS["product_associations_heavy"] = "SELECT * FROM x_assoc"
RESULTS["product_associations_by_code"] = "SELECT * FROM x_assoc_code"
RESULTS["associations_top"] = """
SELECT * EXCLUDE (ProductAOrders, ProductBOrders) FROM x_assoc
ORDER BY Lift DESC, PairOrders DESC, ProductA, ProductB LIMIT 25"""
RESULTS["associations_top_frequency"] = """
SELECT ProductA, ProductB, ProductA_Description, ProductB_Description, PairOrders, Support, Lift
FROM x_assoc ORDER BY PairOrders DESC, Lift DESC, ProductA, ProductB LIMIT 25"""
_CROSS = "SELECT * REPLACE (round(ExecutiveScore, 9) AS ExecutiveScore) FROM x_cross"
RESULTS["cross_sell"] = _CROSS
RESULTS["cross_sell_by_code"] = _CROSS.replace("x_cross", "x_cross_code")
RESULTS["cross_sell_summary"] = "SELECT AssociationType, count(*) AS opportunities FROM x_cross GROUP BY 1"
RESULTS["cross_sell_summary_actions"] = "SELECT CommercialAction, count(*) AS opportunities FROM x_cross GROUP BY 1"
RESULTS["cross_sell_summary_funnel"] = f"""
SELECT count(*) AS filtered, count(*) FILTER (AssociationType <> '{C.FAMILY}') AS executive,
  least(count(*) FILTER (AssociationType <> '{C.FAMILY}'), {S.cross_sell_top}) AS exported FROM x_scored"""

# ---- dashboard -----------------------------------------------------------------

RESULTS["dash_executive_kpis"] = f"""
SELECT count(*) AS transaction_rows, count(DISTINCT InvoiceNo) AS total_orders,
  count(DISTINCT CASE WHEN IsCustomerIdentified THEN CustomerID END) AS identified_customers,
  count(DISTINCT StockCode) AS product_records, count(DISTINCT Country) AS countries,
  ({GROSS})::DOUBLE AS gross_revenue, ({BACK})::DOUBLE AS return_value, {_NET}::DOUBLE AS net_revenue,
  {UNITS} AS units_sold FROM x_tx"""
RESULTS["dash_monthly"] = f"""
SELECT date_trunc('month', InvoiceDate) AS month, {_NET}::DOUBLE AS net_revenue, {SALE_ORDERS} AS orders,
  {UNITS} AS units_sold FROM x_tx GROUP BY 1"""
_COUNTRY = f"""SELECT Country, {_NET}::DOUBLE AS net_revenue, {SALE_ORDERS} AS orders,
  count(DISTINCT CASE WHEN IsCustomerIdentified THEN CustomerID END) AS customers FROM x_tx GROUP BY Country"""
RESULTS["dash_country"] = _COUNTRY
RESULTS["dash_rfm"] = _RFM
RESULTS["dash_high_value_at_risk"] = _RFM + " WHERE Segment = 'At Risk High Value'"
RESULTS["dash_product_master"] = _MASTER
RESULTS["dash_cross_sell"] = _CROSS
RESULTS["dash_build_counts"] = """
SELECT 'kpis' AS "table", 1::BIGINT AS rows
UNION ALL SELECT 'monthly', count(DISTINCT date_trunc('month', InvoiceDate)) FROM x_tx
UNION ALL SELECT 'country', count(DISTINCT Country) FROM x_tx
UNION ALL SELECT 'rfm', count(*) FROM x_rfm
UNION ALL SELECT 'risk', count(*) FROM x_rfm WHERE Segment = 'At Risk High Value'
UNION ALL SELECT 'products', count(*) FROM x_master
UNION ALL SELECT 'cross_sell', count(*) FROM x_cross"""
RESULTS["serve_headline"] = f"""
SELECT {_NET}::DOUBLE AS net_revenue, ({GROSS})::DOUBLE AS gross_revenue,
  count(DISTINCT CASE WHEN IsRevenueEligible THEN InvoiceNo END) AS orders, count(DISTINCT InvoiceNo) AS total_orders,
  printf('£%.2fM', {_NET}::DOUBLE / 1e6) AS net_text, printf('£%.2fM', ({GROSS})::DOUBLE / 1e6) AS gross_text
FROM x_tx"""
RESULTS["serve_monthly"] = f"""
SELECT date_trunc('month', InvoiceDate) AS Month, {_NET}::DOUBLE AS net_revenue FROM x_tx GROUP BY 1"""
RESULTS["serve_monthly_found"] = RESULTS["serve_monthly"]
RESULTS["view_product_categories"] = "SELECT ProductCategory, count(*) AS products FROM x_tax GROUP BY 1"
RESULTS["serve_top_markets"] = f"SELECT * FROM ({_COUNTRY}) ORDER BY net_revenue DESC, Country LIMIT 8"
RESULTS["serve_one_market"] = f"SELECT * FROM ({_COUNTRY}) WHERE Country = 'NATION_7'"
RESULTS["serve_segment_value"] = "SELECT Segment, sum(Monetary)::DOUBLE AS Monetary FROM x_rfm GROUP BY Segment"
RESULTS["serve_one_segment"] = """
SELECT Segment, sum(Monetary)::DOUBLE AS Monetary FROM x_rfm WHERE Segment = 'Champions' GROUP BY Segment"""
RESULTS["serve_risk_summary"] = """
SELECT count(*) AS customers, coalesce(sum(Monetary), 0)::DOUBLE AS risk_value FROM x_rfm WHERE Segment = 'At Risk High Value'"""
RESULTS["serve_risk_table"] = """
SELECT CustomerID, Recency, Frequency, Segment, '£' || format('{:,}', round(Monetary, 0)::BIGINT) AS Monetary
FROM x_rfm WHERE Segment = 'At Risk High Value' ORDER BY x_rfm.Monetary DESC, CustomerID LIMIT 6"""
RESULTS["serve_top_products"] = f"""
SELECT StockCode AS Product, Description, '£' || format('{{:,}}', round(NetRevenue, 0)::BIGINT) AS "Net Revenue",
  format('{{:,}}', UnitsSold) AS "Units Sold"
FROM x_master WHERE StockCode NOT IN ({texts(C.NON_MERCHANDISE_CODES)}) ORDER BY NetRevenue DESC, StockCode LIMIT 6"""
for _name, _table in [("serve_cross_sell", "x_cross"), ("serve_cross_sell_by_code", "x_cross_code")]:
    RESULTS[_name] = f"""
SELECT coalesce(a.Description, ProductA) AS "Product A", coalesce(b.Description, ProductB) AS "Product B", PairOrders,
  printf('%.1fx', Lift) AS Lift, printf('%.1f%%', Confidence_A_to_B * 100) AS Confidence
FROM {_table} c LEFT JOIN x_master a ON c.ProductA = a.StockCode LEFT JOIN x_master b ON c.ProductB = b.StockCode
WHERE ExecutiveRank <= 6"""
RESULTS["serve_filter_options"] = """
SELECT 'market' AS filter, Country AS choice FROM x_tx GROUP BY 2 UNION ALL SELECT 'segment', Segment FROM x_rfm GROUP BY 2"""
