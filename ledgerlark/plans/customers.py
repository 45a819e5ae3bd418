"""Customer value, concentration, return risk and repeat purchase.

All results read `customer_facts`, one row per identified customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.labels import first_label
from ledgerlark.functions.measures import net_commercial, number, percent, ratio
from ledgerlark.operators.ranking import ntile_bucket, numbered, positions, top_share


def _with_net(customers: DataFrame) -> DataFrame:
    return customers.withColumn("Net", net_commercial())


def customer_value_list(customers: DataFrame, n: int = 50) -> DataFrame:
    """Customers with sales by net value of all lines, with the average order value."""
    return (
        customers.filter("GrossRevenue > 0")
        .select(
            "CustomerID",
            F.col("SalesOrders").alias("orders"),
            number("GrossRevenue").alias("gross_revenue"),
            number("ReturnValue").alias("return_value"),
            number("NetAll", 2).alias("net_revenue"),
            F.col("UnitsSold").alias("units_sold"),
            F.round(ratio("GrossRevenue", "SalesOrders"), 2).alias("average_order_value"),
        )
        .orderBy(F.desc("net_revenue"), "CustomerID")
        .limit(n)
    )


def by_net(customers: DataFrame) -> DataFrame:
    """Customers numbered by net value, greatest first. Those with a positive value stand before all others."""
    return numbered(_with_net(customers).select("CustomerID", "Net"), [F.desc_nulls_last("Net"), F.asc("CustomerID")])


_POSITIVE = "Net > 0"


def positive_concentration(ranked: DataFrame) -> DataFrame:
    """Top shares among customers with a positive net value, from `by_net`."""
    return top_share(ranked, "Net", C.TOP_PERCENTS, "ceil", leading=_POSITIVE)


def identified_concentration(ranked: DataFrame) -> DataFrame:
    """Top shares among all identified customers, from `by_net`."""
    return top_share(ranked, "Net", C.TOP_PERCENTS, "ceil", suffix="pct_share")


def return_risk_list(customers: DataFrame, n: int = 50) -> DataFrame:
    """Customers with the highest return value rate."""
    returned = F.abs("ReturnValue")
    return (
        customers.select(
            "CustomerID",
            F.col("SalesOrders").alias("sales_orders"),
            F.col("ReturnOrders").alias("return_orders"),
            number("GrossRevenue", 2).alias("gross_revenue"),
            number(returned, 2).alias("return_value"),
            percent(returned, "GrossRevenue").alias("return_value_rate"),
        )
        .filter("gross_revenue > 0")
        .orderBy(F.desc("return_value_rate"), "CustomerID")
        .limit(n)
    )


def value_quartiles(ranked: DataFrame) -> DataFrame:
    """Customers and value per quartile of positive net value, from `by_net`.

    Quartiles count from the least value up; customers of equal value may change places, which changes no result.
    """
    placed = positions(ranked, "_at").filter(_POSITIVE)
    total = placed.agg(F.count("*")).scalar()
    tile = ntile_bucket(total - F.col("_at") + 1, total, 4)
    return (
        placed.groupBy(tile.alias("value_quartile"))
        .agg(F.count("*").alias("customers"), F.sum("Net").alias("_net"))
        .select(
            "value_quartile",
            "customers",
            number("_net", 2).alias("net_revenue"),
            F.round(ratio("_net", "customers"), 2).alias("average_customer_value"),
        )
        .orderBy(F.desc("value_quartile"))
    )


def repeat_purchase(customers: DataFrame) -> DataFrame:
    """One-time and repeat customers; customers without any sale count in the base."""
    return customers.agg(
        F.count("*").alias("identified_customers"),
        F.count_if(F.col("SalesOrders") == 1).alias("one_time_customers"),
        F.count_if(F.col("SalesOrders") >= 2).alias("repeat_customers"),
    ).withColumn("repeat_customer_rate", percent("repeat_customers", "identified_customers"))


def value_by_return_risk(customers: DataFrame, high_value: float = 10000) -> DataFrame:
    """Customers with sales by value class and return-risk class."""
    rate = ratio(F.abs("ReturnValue"), "GrossRevenue")
    return (
        _with_net(customers.filter("GrossRevenue > 0"))
        .groupBy(
            first_label([(F.col("GrossRevenue") >= high_value, "High Value")], "Standard Value").alias("value_class"),
            first_label(
                [(rate >= 0.30, "High Return Risk"), (rate >= 0.15, "Moderate Return Risk")], "Low Return Risk"
            ).alias("return_risk_class"),
        )
        .agg(F.count("*").alias("customers"), number(F.sum("Net"), 2).alias("net_revenue"))
        .orderBy(F.desc("net_revenue"), "value_class", "return_risk_class")
    )


def customer_health(customers: DataFrame) -> DataFrame:
    """Average value, orders, repeat rate and share of customers with returns."""
    totals = _with_net(customers).agg(
        F.count("*").alias("customers"),
        F.sum("Net").alias("_net"),
        F.sum("SalesOrders").alias("_orders"),
        F.count_if(F.col("SalesOrders") > 1).alias("_repeat"),
        F.count_if(F.col("ReturnValue") < 0).alias("_returning"),
    )
    mean = F.round(ratio("_net", "customers"), 2)
    return totals.select(
        "customers",
        mean.alias("avg_customer_value"),
        mean.alias("revenue_per_customer"),
        F.round(ratio("_orders", "customers"), 2).alias("average_orders_per_customer"),
        percent("_repeat", "customers").alias("repeat_customer_rate"),
        percent("_returning", "customers").alias("customers_with_returns"),
    )


def opportunity_matrix(customers: DataFrame, high_value: float = 3000) -> DataFrame:
    """Customers and value by value class of net revenue."""
    return (
        _with_net(customers)
        .groupBy(first_label([(F.col("Net") >= high_value, "High Value")], "Standard Value").alias("value_class"))
        .agg(F.count("*").alias("customers"), F.sum("Net").alias("_net"))
        .select(
            "value_class",
            "customers",
            number("_net", 2).alias("net_revenue"),
            F.round(ratio("_net", "customers"), 2).alias("average_customer_value"),
        )
        .orderBy(F.desc("net_revenue"), "value_class")
    )
