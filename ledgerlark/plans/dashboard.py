"""Serving tables of the dashboard and the queries its pages run over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.lookup import find_column, find_date_column, first_value
from ledgerlark.functions.measures import number
from ledgerlark.functions.text import strip
from ledgerlark.operators.picks import first_row
from ledgerlark.plans import kpis

NET_NAMES = ["NetRevenue", "net_revenue", "Net Revenue", "Revenue", "revenue"]
MONTH_NAMES = ["Month", "YearMonth", "Year_Month", "Period", "Date", "InvoiceMonth"]


def high_value_at_risk(rfm: DataFrame) -> DataFrame:
    """RFM rows of the high-value customers at risk, most valuable first."""
    return rfm.filter(F.col("Segment") == C.AT_RISK_HIGH_VALUE).orderBy(F.desc("Monetary"), "CustomerID")


def serving_kpis(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Headline KPIs, and in `orders` the invoices with a sale, so that a page need not count them."""
    sales = F.col("SalesOrders").alias("orders")
    return kpis.executive_kpis(orders, products, None, sales).drop("net_revenue_per_order")


#: Serving tables by role, money unrounded. Each takes the workspace and builds only the stages it reads.
ROLES = {
    "kpis": lambda w: serving_kpis(w.orders, w.products),
    "monthly": lambda w: kpis.monthly_net(w.orders, digits=None),
    "country": lambda w: kpis.country_net(w.orders, digits=None).drop("revenue_per_order"),
    "rfm": lambda w: w.rfm,
    "risk": lambda w: high_value_at_risk(w.rfm),
    "products": lambda w: w.master,
    "cross_sell": lambda w: w.cross_sell,
}


def build_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every serving table."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(role).alias("table"), "rows") for role, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def headline(kpi_table: DataFrame) -> DataFrame:
    """Headline values by whichever candidate column is present, and display texts of the money.

    `orders` are the invoices with a sale; `total_orders` counts all invoices.
    """
    values = kpi_table.select(
        first_value(kpi_table, ["net_revenue", "NetRevenue", "net_revenue_value"]).cast("double").alias("net_revenue"),
        first_value(kpi_table, ["gross_sales_revenue", "GrossRevenue", "gross_revenue"])
        .cast("double")
        .alias("gross_revenue"),
        first_value(kpi_table, ["unique_orders", "UniqueOrders", "orders"])
        .cast("bigint")
        .alias("orders"),
        first_value(kpi_table, ["total_orders"]).cast("bigint").alias("total_orders"),
    )
    return values.withColumns({f"{name}_text": millions(F.col(f"{name}_revenue")) for name in ("net", "gross")})


def monthly_series(monthly: DataFrame) -> DataFrame:
    """Net revenue in month order, whatever the date column is called."""
    month = find_date_column(monthly, MONTH_NAMES)
    if month is None:
        raise ValueError(f"no date column among {monthly.columns}")
    return monthly.select(
        F.col(month).cast("string").try_cast("timestamp_ntz").alias("Month"),
        number(find_column(monthly, NET_NAMES)).alias("net_revenue"),
    ).orderBy("Month")


def top_markets(country: DataFrame, market: str | None = None, n: int = 8) -> DataFrame:
    """Best markets (or the chosen one), in ascending order for display."""
    named = country.withColumn("Country", strip(F.col("Country")))
    if market is not None:
        named = named.filter(F.col("Country") == market)
    net = find_column(named, NET_NAMES)
    best = named.orderBy(F.desc(net), "Country").limit(n)
    return best.orderBy(F.asc(net), F.desc("Country"))


def segment_value(rfm: DataFrame, segment: str | None = None) -> DataFrame:
    """Revenue per segment (or the chosen one); customers per segment where no revenue is known."""
    chosen = rfm if segment is None else rfm.filter(strip(F.col("Segment")) == segment)
    money = find_column(chosen, ["Monetary"])
    if money is None:
        return chosen.groupBy("Segment").agg(F.count("*").alias("Customers")).orderBy(F.desc("Customers"), "Segment")
    return chosen.groupBy("Segment").agg(number(F.sum(money)).alias("Monetary")).orderBy(F.desc("Monetary"), "Segment")


def risk_summary(risk: DataFrame) -> DataFrame:
    """Customers at risk and the value they stand for."""
    value = find_column(risk, ["Monetary", "NetRevenue"])
    total = number(F.coalesce(F.sum(value), F.lit(0))) if value else F.lit(0.0)
    return risk.agg(F.count("*").alias("customers"), total.alias("risk_value"))


def risk_table(risk: DataFrame, n: int = 6) -> DataFrame:
    """Most valuable customers at risk, with the display text of their value."""
    return (
        risk.orderBy(F.desc("Monetary"), "CustomerID")
        .limit(n)
        .select("CustomerID", "Recency", "Frequency", "Segment", pounds(F.col("Monetary")).alias("Monetary"))
    )


def merchandise_only(products: DataFrame) -> DataFrame:
    """Products whose code is not a service, fee or gift code."""
    code = strip(F.col("StockCode"))
    return products.withColumn("StockCode", code).filter(~code.isin(C.NON_MERCHANDISE_CODES))


def best_products(products: DataFrame, n: int = 6) -> DataFrame:
    """Merchandise with the highest net revenue, under display names and texts."""
    return (
        merchandise_only(products)
        .orderBy(F.desc("NetRevenue"), "StockCode")
        .limit(n)
        .select(
            F.col("StockCode").alias("Product"),
            "Description",
            pounds(F.col("NetRevenue")).alias("Net Revenue"),
            F.format_number("UnitsSold", 0).alias("Units Sold"),
        )
    )


def cross_sell_table(cross_sell: DataFrame, products: DataFrame, n: int = 6) -> DataFrame:
    """Best opportunities with product descriptions, or the code where none is known."""
    names = first_row(merchandise_only(products).select("StockCode", "Description"), "StockCode")
    best = cross_sell.orderBy("ExecutiveRank").limit(n)
    for side in "AB":
        lookup = names.select(F.col("StockCode").alias(f"Product{side}"), F.col("Description").alias(f"_{side}"))
        best = best.join(lookup, f"Product{side}", "left")
    return best.orderBy("ExecutiveRank").select(
        F.coalesce("_A", "ProductA").alias("Product A"),
        F.coalesce("_B", "ProductB").alias("Product B"),
        "PairOrders",
        F.format_string("%.1fx", "Lift").alias("Lift"),
        F.format_string("%.1f%%", F.col("Confidence_A_to_B") * 100).alias("Confidence"),
    )


def filter_options(country: DataFrame, rfm: DataFrame) -> DataFrame:
    """Choices of the market and segment filters."""
    markets = country.select(F.lit("market").alias("filter"), strip(F.col("Country")).alias("choice"))
    segments = rfm.select(F.lit("segment").alias("filter"), strip(F.col("Segment")).alias("choice"))
    return markets.unionByName(segments).filter(F.col("choice").isNotNull()).distinct().orderBy("filter", "choice")


def millions(amount: Column) -> Column:
    """Amount in millions of pounds with two decimals."""
    return F.format_string("£%.2fM", amount / 1_000_000)


def pounds(amount: Column) -> Column:
    """Amount as whole pounds with thousands separators."""
    return F.concat(F.lit("£"), F.format_number(F.round(amount, 0), 0))
