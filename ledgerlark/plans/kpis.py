"""Commercial KPIs by total, month, country, product, customer and transaction type.

`orders` is `order_facts`, `customers` is `customer_facts` and `products` is
`product_facts`; `NetAll` counts every line, `net_commercial` sales and returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.measures import net_commercial, number, ratio
from ledgerlark.operators.picks import largest_names
from ledgerlark.operators.ranking import numbered, top_share
from ledgerlark.operators.rollup import roll_up, with_distinct


def _product_records(products: DataFrame):
    return products.agg(F.count("StockCode")).scalar()


def data_quality(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Rows and distinct invoices, products, customers and countries."""
    distinct = {"unique_invoices": "InvoiceNo", "identified_customers": "CustomerID", "countries": "Country"}
    rows = orders.agg(F.sum("Lines").alias("total_transaction_rows"))
    return with_distinct(rows, orders, [], distinct).withColumn("unique_products", _product_records(products))


def revenue_kpis(orders: DataFrame) -> DataFrame:
    """Gross, return and net commercial value."""
    return roll_up(orders).select(
        number("GrossRevenue", 2).alias("gross_sales_revenue"),
        number("ReturnValue", 2).alias("return_value"),
        number(net_commercial(), 2).alias("net_commercial_value"),
    )


def monthly_trend(orders: DataFrame) -> DataFrame:
    """Revenue and orders per month; net counts every transaction type."""
    return (
        roll_up(orders.filter(F.col("Month").isNotNull()), "Month")
        .select(
            F.col("Month").alias("sales_month"),
            number("GrossRevenue", 2).alias("gross_revenue"),
            number("ReturnValue", 2).alias("return_value"),
            number("NetAll", 2).alias("net_revenue"),
            F.col("Orders").alias("orders"),
        )
        .orderBy("sales_month")
    )


def country_performance(orders: DataFrame) -> DataFrame:
    """Orders, customers, units and revenue per country; net counts every type."""
    return (
        with_distinct(roll_up(orders, "Country"), orders, ["Country"], {"customers": "CustomerID"})
        .select(
            "Country",
            F.col("Orders").alias("orders"),
            "customers",
            F.col("UnitsSold").alias("units_sold"),
            number("GrossRevenue", 2).alias("gross_revenue"),
            number("NetAll", 2).alias("net_revenue"),
        )
        .orderBy(F.desc("net_revenue"), "Country")
    )


def top_products(products: DataFrame, names: DataFrame, n: int = 50) -> DataFrame:
    """Products with the highest net value; only the rows shown are given a description."""
    best = (
        products.select(
            "StockCode",
            F.col("UnitsSold").alias("units_sold"),
            F.col("SalesOrders").alias("orders"),
            number("GrossRevenue", 2).alias("gross_revenue"),
            number("NetAll", 2).alias("net_revenue"),
        )
        .orderBy(F.desc("net_revenue"), "StockCode")
        .limit(n)
    )
    texts = largest_names(names).withColumnRenamed("StockCode", "_code")
    return (
        best.join(texts, F.col("StockCode").eqNullSafe(F.col("_code")), "left")
        .select(
            "StockCode", F.col("MaxDescription").alias("Description"), "units_sold", "orders", "gross_revenue",
            "net_revenue",
        )
        .orderBy(F.desc("net_revenue"), "StockCode")
    )


def top_customers(customers: DataFrame, n: int = 50) -> DataFrame:
    """Customers with the highest net value."""
    return (
        customers.select(
            "CustomerID",
            F.col("SalesOrders").alias("orders"),
            F.col("UnitsSold").alias("units"),
            number("GrossRevenue", 2).alias("gross_revenue"),
            number("NetAll", 2).alias("net_revenue"),
        )
        .orderBy(F.desc("net_revenue"), "CustomerID")
        .limit(n)
    )


def by_all_lines(customers: DataFrame) -> DataFrame:
    """Customers numbered by the value of all their lines, greatest first."""
    return numbered(customers.select("CustomerID", "NetAll"), [F.desc_nulls_last("NetAll"), F.asc("CustomerID")])


def customer_concentration(ranked: DataFrame) -> DataFrame:
    """Share of the top customers in the value of all lines, from `by_all_lines`."""
    return top_share(ranked, "NetAll", C.TOP_PERCENTS, "ceil")


def customer_returns(customers: DataFrame) -> DataFrame:
    """Sales and return activity of customers with sales, largest returns first."""
    return (
        customers.select(
            "CustomerID",
            F.col("SalesOrders").alias("sales_orders"),
            F.col("ReturnOrders").alias("return_orders"),
            number("GrossRevenue", 2).alias("gross_sales"),
            number("ReturnValue", 2).alias("return_value"),
            number("NetAll", 2).alias("net_revenue"),
        )
        .filter("gross_sales > 0")
        .orderBy("return_value", "CustomerID")
    )


def type_distribution(orders: DataFrame) -> DataFrame:
    """Rows, invoices and value per transaction type."""
    return (
        roll_up(orders, "TransactionType")
        .select(
            "TransactionType",
            F.col("Lines").alias("transaction_rows"),
            F.col("Orders").alias("invoices"),
            number("NetAll", 2).alias("transaction_value"),
        )
        .orderBy(F.desc("transaction_value"), "TransactionType")
    )


def executive_kpis(orders: DataFrame, products: DataFrame, digits: int | None = 2, *more: Column) -> DataFrame:
    """Headline KPIs; `digits=None` keeps money unrounded, `more` adds columns of `roll_up`."""
    totals = with_distinct(
        roll_up(orders), orders, [], {"identified_customers": "CustomerID", "countries": "Country"}
    )
    return totals.select(
        F.col("Lines").alias("transaction_rows"),
        F.col("Orders").alias("total_orders"),
        "identified_customers",
        _product_records(products).alias("product_records"),
        "countries",
        number("GrossRevenue", digits).alias("gross_revenue"),
        number("ReturnValue", digits).alias("return_value"),
        number(net_commercial(), digits).alias("net_revenue"),
        F.col("UnitsSold").alias("units_sold"),
        F.round(ratio(net_commercial(), F.col("SalesOrders")), 2).alias("net_revenue_per_order"),
        *more,
    )


def monthly_net(orders: DataFrame, digits: int | None = 2) -> DataFrame:
    """Net commercial revenue, sales orders and units per month."""
    return (
        roll_up(orders, "Month")
        .select(
            F.col("Month").alias("month"),
            number(net_commercial(), digits).alias("net_revenue"),
            F.col("SalesOrders").alias("orders"),
            F.col("UnitsSold").alias("units_sold"),
        )
        .orderBy("month")
    )


def country_net(orders: DataFrame, digits: int | None = 2) -> DataFrame:
    """Net commercial revenue, sales orders, customers and revenue per order by country."""
    rolled = with_distinct(roll_up(orders, "Country"), orders, ["Country"], {"customers": "CustomerID"})
    return rolled.select(
        "Country",
        number(net_commercial(), digits).alias("net_revenue"),
        F.col("SalesOrders").alias("orders"),
        "customers",
        F.round(ratio(net_commercial(), F.col("SalesOrders")), 2).alias("revenue_per_order"),
    ).orderBy(F.desc("net_revenue"), "Country")
