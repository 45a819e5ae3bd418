"""RFM scores, customer value with running totals, and customer return risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.labels import return_risk, rfm_segment, strategic_class
from ledgerlark.functions.measures import net_commercial, number, ratio
from ledgerlark.operators.profile import share_of_total
from ledgerlark.operators.ranking import global_rank, rank_bucket, running_total, share_of_top


def _day(column: str):
    return F.to_date(column)


def customer_rfm(customers: DataFrame) -> DataFrame:
    """Recency, frequency, monetary value, scores and segment of customers with sales.

    The observation date and the recency edges are scalar subqueries over
    customer rows. Recency has at most one value per day of history, so its
    exact percentiles stay small; frequency and money are ranked globally. A
    customer whose sales carry no invoice number counts, with no order and no
    average order value.
    """
    buyers = customers.filter("SaleLines > 0")
    observed = F.date_add(buyers.agg(F.to_date(F.max("LastSale"))).scalar(), 1)
    base = buyers.select(
        "CustomerID",
        F.date_diff(observed, _day("LastSale")).cast("bigint").alias("Recency"),
        F.col("SalesOrders").alias("Frequency"),
        F.col("GrossRevenue").alias("Monetary"),
        F.col("UnitsSold").alias("TotalUnits"),
        F.col("FirstSale").alias("FirstPurchase"),
        F.col("LastSale").alias("LastPurchase"),
        F.date_diff(_day("LastSale"), _day("FirstSale")).cast("bigint").alias("CustomerLifetimeDays"),
        ratio("GrossRevenue", "SalesOrders").alias("AverageOrderValue"),
    )
    edges = base.agg(F.percentile("Recency", F.array(*[F.lit(k / 5) for k in range(1, 5)]))).scalar()
    older = sum((F.col("Recency") > F.element_at(F.col("_edges"), k)).cast("bigint") for k in range(1, 5))
    scored = base.withColumn("_edges", edges).withColumn("R_Score", F.lit(5) - older).drop("_edges")
    for value, score in [("Frequency", "F_Score"), ("Monetary", "M_Score")]:
        scored = global_rank(scored, [F.col(value).asc(), F.col("CustomerID").asc()], "_at", "_n")
        scored = scored.withColumn(score, rank_bucket(F.col("_at"), F.col("_n"), 5)).drop("_at", "_n")
    scores = [F.col("R_Score"), F.col("F_Score"), F.col("M_Score")]
    return scored.withColumns(
        {
            "R_Score": scores[0].cast("bigint"),
            "RFM_Score": F.concat(*[s.cast("string") for s in scores]),
            "RFM_Total": (scores[0] + scores[1] + scores[2]).cast("bigint"),
            "Segment": rfm_segment(*scores),
        }
    )


def rfm_scope(orders: DataFrame) -> DataFrame:
    """Sale lines and customers that the scores stand for, and the observation date."""
    sales = orders.filter(F.col("IsRevenueEligible") & F.col("CustomerID").isNotNull())
    return sales.agg(
        F.sum("Lines").alias("revenue_eligible_rows"),
        F.countDistinct("CustomerID").alias("customers"),
        F.date_add(F.to_date(F.max("LastDate")), 1).cast("timestamp_ntz").alias("observation_date"),
    )


def segment_counts(rfm: DataFrame) -> DataFrame:
    """Customers and revenue per segment."""
    return rfm.groupBy("Segment").agg(F.count("*").alias("customers"), number(F.sum("Monetary")).alias("revenue"))


def top_monetary(rfm: DataFrame, n: int = 15) -> DataFrame:
    """Customers with the highest monetary value."""
    return (
        rfm.orderBy(F.desc("Monetary"), "CustomerID")
        .limit(n)
        .select("CustomerID", "Recency", "Frequency", number("Monetary").alias("Monetary"), "AverageOrderValue", "Segment")
    )


def _segment_measures() -> list:
    return [
        number(F.sum("Monetary"), 2),
        F.round(ratio(F.sum("Monetary"), F.count("Monetary")), 2),
        F.round(ratio(F.sum("Frequency"), F.count("Frequency")), 2),
        F.round(ratio(F.sum("Recency"), F.count("Recency")), 1),
    ]


def segment_performance(rfm: DataFrame) -> DataFrame:
    """Customers, revenue and averages per segment."""
    revenue, value, orders, days = _segment_measures()
    return (
        rfm.groupBy("Segment")
        .agg(
            F.count("*").alias("customers"),
            revenue.alias("gross_revenue"),
            value.alias("average_customer_value"),
            orders.alias("average_orders"),
            days.alias("average_recency_days"),
        )
        .orderBy(F.desc("gross_revenue"), "Segment")
    )


def at_risk_customers(rfm: DataFrame, n: int = 50) -> DataFrame:
    """High-value customers at risk, with revenue per order."""
    return (
        rfm.filter(F.col("Segment") == C.AT_RISK_HIGH_VALUE)
        .orderBy(F.desc("Monetary"), "CustomerID")
        .limit(n)
        .select(
            "CustomerID",
            "Segment",
            "Recency",
            "Frequency",
            number("Monetary", 2).alias("gross_revenue"),
            F.round(ratio("Monetary", "Frequency"), 2).alias("revenue_per_order"),
        )
    )


def recovery_opportunity(rfm: DataFrame) -> DataFrame:
    """Size and value of the high-value customers at risk."""
    revenue, value, orders, days = _segment_measures()
    return rfm.filter(F.col("Segment") == C.AT_RISK_HIGH_VALUE).agg(
        F.count("*").alias("high_value_at_risk_customers"),
        revenue.alias("recoverable_gross_revenue"),
        value.alias("average_customer_value"),
        days.alias("average_days_since_purchase"),
        orders.alias("average_historical_orders"),
    )


def customer_value(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    """Net value, return rates, RFM attributes and running share of customers with sales."""
    sold = customers.filter("SaleLines > 0").select(
        "CustomerID",
        "GrossRevenue",
        "SalesOrders",
        "UnitsSold",
        "ReturnValue",
        "ReturnOrders",
        F.abs("ReturnedUnits").alias("ReturnedUnits"),
        net_commercial().alias("NetRevenue"),
        ratio("ReturnOrders", "SalesOrders").alias("ReturnRate"),
        ratio(F.abs("ReturnValue"), "GrossRevenue").alias("ReturnValueRate"),
    )
    attributes = rfm.select(
        "CustomerID", "Recency", "Frequency", "Monetary", "Segment", "CustomerLifetimeDays", "AverageOrderValue"
    )
    ranked = running_total(
        sold.join(attributes, "CustomerID", "left"),
        [F.col("NetRevenue").desc(), F.col("CustomerID").asc()],
        "NetRevenue",
        "CumulativeNetRevenue",
        "RevenueRank",
    )
    total = ranked.agg(F.sum("NetRevenue").cast("double")).scalar()
    return ranked.withColumn(
        "CumulativeRevenuePct", F.try_divide(number("CumulativeNetRevenue"), total) * 100
    )


def value_totals(value: DataFrame) -> DataFrame:
    """Customers, gross, returns, net, and the high-value customers at risk."""
    at_risk = F.when(F.col("Segment") == C.AT_RISK_HIGH_VALUE, F.col("NetRevenue"))
    return value.agg(
        F.count("*").alias("customers"),
        number(F.sum("GrossRevenue")).alias("gross_revenue"),
        number(F.sum("ReturnValue")).alias("returns"),
        number(F.sum("NetRevenue")).alias("net_revenue"),
        F.count(at_risk).alias("at_risk_customers"),
        number(F.coalesce(F.sum(at_risk), F.lit(0))).alias("at_risk_net_revenue"),
        ratio(F.sum(at_risk), F.count(at_risk)).alias("at_risk_average"),
    )


def top_value(value: DataFrame, n: int = 15) -> DataFrame:
    """Customers with the highest net revenue."""
    return value.filter(F.col("RevenueRank") <= n).select(
        "RevenueRank",
        "CustomerID",
        number("GrossRevenue").alias("GrossRevenue"),
        number("ReturnValue").alias("ReturnValue"),
        number("NetRevenue").alias("NetRevenue"),
        "ReturnValueRate",
        "Segment",
    )


def value_concentration(value: DataFrame) -> DataFrame:
    """Share of net revenue held by the top customers; whole customers only, at least one."""
    total = value.agg(F.count("*")).scalar()
    return share_of_top(value, "NetRevenue", F.col("RevenueRank"), total, C.TOP_PERCENTS, "floor", "pct_share")


def customer_risk(value: DataFrame) -> DataFrame:
    """Value tier, return risk and strategic class of every customer with sales."""
    placed = global_rank(value, [F.col("NetRevenue").asc(), F.col("CustomerID").asc()], "_at", "_n")
    tier = F.element_at(
        F.array(*[F.lit(t) for t in C.VALUE_TIERS]), rank_bucket(F.col("_at"), F.col("_n"), 4).cast("int")
    )
    return (
        placed.withColumn("ValueTier", tier)
        .withColumn("ReturnRisk", return_risk(F.col("ReturnValueRate")))
        .withColumn("StrategicClass", strategic_class(F.col("ValueTier"), F.col("ReturnRisk")))
        .drop("_at", "_n")
    )


def class_summary(risk: DataFrame) -> DataFrame:
    """Customers, revenue and share of net revenue per strategic class."""
    grouped = risk.groupBy("StrategicClass").agg(
        F.count("CustomerID").alias("Customers"),
        F.sum("NetRevenue").alias("NetRevenue"),
        F.sum("GrossRevenue").alias("GrossRevenue"),
        F.sum("ReturnValue").alias("ReturnValue"),
    )
    shared = share_of_total(grouped, "NetRevenue", "RevenueShare")
    return shared.withColumns({c: number(c) for c in ["NetRevenue", "GrossRevenue", "ReturnValue"]})


def top_returns(risk: DataFrame, n: int = 20) -> DataFrame:
    """Customers with the largest return value."""
    return (
        risk.orderBy("ReturnValue", "CustomerID")
        .limit(n)
        .select(
            "CustomerID",
            number("GrossRevenue").alias("GrossRevenue"),
            number("ReturnValue").alias("ReturnValue"),
            number("NetRevenue").alias("NetRevenue"),
            "ReturnValueRate",
            "ValueTier",
            "ReturnRisk",
            "StrategicClass",
        )
    )


def high_risk_customers(risk: DataFrame, n: int = 20) -> DataFrame:
    """High-value customers with a high return risk, by net revenue."""
    return (
        risk.filter(F.col("StrategicClass") == C.HIGH_VALUE_HIGH_RISK)
        .orderBy(F.desc("NetRevenue"), "CustomerID")
        .limit(n)
        .select(
            "CustomerID",
            number("NetRevenue").alias("NetRevenue"),
            number("ReturnValue").alias("ReturnValue"),
            "ReturnValueRate",
            "Segment",
        )
    )


def high_risk_totals(risk: DataFrame) -> DataFrame:
    """Count and net revenue of high-value customers with a high return risk."""
    chosen = risk.filter(F.col("StrategicClass") == C.HIGH_VALUE_HIGH_RISK)
    return chosen.agg(
        F.count("*").alias("customers"), number(F.coalesce(F.sum("NetRevenue"), F.lit(0))).alias("net_revenue")
    )
