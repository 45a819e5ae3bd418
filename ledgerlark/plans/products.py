"""Product intelligence, taxonomy and the merchandise results built on them.

`products` is `product_facts`. Facts are aggregated before they meet the
taxonomy, so no transaction line is joined where a product row is enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.labels import product_category
from ledgerlark.functions.measures import net_commercial, number, percent, ratio
from ledgerlark.operators.picks import largest_names
from ledgerlark.operators.profile import share_of_total
from ledgerlark.operators.ranking import global_rank, numbered, share_of_top, top_share


def _sold(products: DataFrame) -> DataFrame:
    return products.filter("SaleLines > 0 AND StockCode IS NOT NULL")


def product_intelligence(products: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Sales, returns, ratios, share and rank of products with sales."""
    base = (
        _sold(products)
        .join(descriptions, "StockCode", "left")
        .select(
            "StockCode",
            "GrossRevenue",
            "UnitsSold",
            "SalesLines",
            "SalesOrders",
            ratio("PriceSum", "PriceCount").alias("AvgUnitPrice"),
            "Description",
            "ReturnValue",
            F.abs("ReturnedUnits").alias("ReturnedUnits"),
            "ReturnLines",
            "ReturnOrders",
            net_commercial().alias("NetRevenue"),
            ratio(F.abs("ReturnValue"), "GrossRevenue").alias("ReturnValueRate"),
            ratio(F.abs("ReturnedUnits"), "UnitsSold").alias("ReturnUnitRate"),
            ratio("GrossRevenue", "UnitsSold").alias("RevenuePerUnit"),
            ratio("GrossRevenue", "SalesOrders").alias("RevenuePerOrder"),
        )
    )
    ranked = global_rank(base, [F.col("NetRevenue").desc(), F.col("StockCode").asc()], "RevenueRank")
    return share_of_total(ranked, "NetRevenue", "RevenueShare")


def intelligence_totals(intelligence: DataFrame) -> DataFrame:
    """Products with sales and their revenue."""
    return intelligence.agg(
        F.count("*").alias("products"),
        number(F.sum("GrossRevenue")).alias("gross_revenue"),
        number(F.sum("ReturnValue")).alias("returns"),
        number(F.sum("NetRevenue")).alias("net_revenue"),
    )


_MONEY = ["GrossRevenue", "ReturnValue", "NetRevenue"]


def _top(intelligence: DataFrame, order, columns: list[str], n: int) -> DataFrame:
    picked = intelligence.orderBy(order, "StockCode").limit(n).select("StockCode", "Description", *columns)
    return picked.withColumns({c: number(c) for c in columns if c in _MONEY})


def top_by_net(intelligence: DataFrame, n: int = 20) -> DataFrame:
    """Products with the highest net revenue."""
    columns = ["GrossRevenue", "ReturnValue", "NetRevenue", "UnitsSold", "ReturnValueRate", "RevenueShare"]
    return _top(intelligence, F.desc("NetRevenue"), columns, n)


def top_by_units(intelligence: DataFrame, n: int = 20) -> DataFrame:
    """Products with the most units sold."""
    return _top(
        intelligence, F.desc("UnitsSold"), ["UnitsSold", "GrossRevenue", "NetRevenue", "RevenuePerUnit"], n
    )


def top_by_returns(intelligence: DataFrame, n: int = 20) -> DataFrame:
    """Products with the largest return value."""
    return _top(
        intelligence, F.asc("ReturnValue"), ["GrossRevenue", "ReturnValue", "NetRevenue", "ReturnValueRate"], n
    )


def product_concentration(intelligence: DataFrame) -> DataFrame:
    """Share of net revenue held by the top products; whole products only, at least one."""
    total = intelligence.agg(F.count("*")).scalar()
    return share_of_top(intelligence, "NetRevenue", F.col("RevenueRank"), total, C.TOP_PERCENTS, "floor", "pct_share")


def product_taxonomy(products: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Category, merchandise flag and revenue share of products with sales."""
    base = (
        _sold(products)
        .join(descriptions, "StockCode", "left")
        .select("StockCode", "GrossRevenue", "UnitsSold", "SalesLines", "SalesOrders", "Description")
        .withColumn("ProductCategory", product_category(F.col("StockCode"), F.col("Description")))
        .withColumn("CommercialProduct", F.col("ProductCategory") == C.MERCHANDISE)
    )
    total = _sold(products).agg(F.sum("GrossRevenue").cast("double")).scalar()
    return base.withColumn("RevenueShare", F.try_divide(number("GrossRevenue"), total) * 100)


def category_counts(taxonomy: DataFrame) -> DataFrame:
    """Products, revenue, units and revenue share per category."""
    grouped = taxonomy.groupBy("ProductCategory").agg(
        F.count("StockCode").alias("Products"),
        F.sum("GrossRevenue").alias("Revenue"),
        F.sum("UnitsSold").alias("Units"),
    )
    return share_of_total(grouped, "Revenue", "RevenueShare").withColumn("Revenue", number("Revenue"))


def top_taxonomy_merchandise(taxonomy: DataFrame, n: int = 20) -> DataFrame:
    """Merchandise with the highest gross revenue."""
    return (
        taxonomy.filter("CommercialProduct")
        .orderBy(F.desc("GrossRevenue"), "StockCode")
        .limit(n)
        .select(
            "StockCode", "Description", number("GrossRevenue").alias("GrossRevenue"), "UnitsSold", "SalesOrders",
            "RevenueShare",
        )
    )


def merchandise_universe(taxonomy: DataFrame) -> DataFrame:
    """Merchandise products, their revenue and its share of all sales."""
    genuine = F.when(F.col("CommercialProduct"), F.col("GrossRevenue"))
    return taxonomy.agg(
        F.count(genuine).alias("merchandise_products"),
        number(F.sum(genuine)).alias("merchandise_revenue"),
        (ratio(F.sum(genuine), F.sum("GrossRevenue")) * 100).alias("merchandise_share"),
    )


def _merchandise(products: DataFrame, taxonomy: DataFrame) -> DataFrame:
    genuine = taxonomy.filter(F.col("ProductCategory") == C.MERCHANDISE).select("StockCode", "ProductCategory")
    return products.join(genuine, "StockCode")


def top_merchandise(products: DataFrame, names: DataFrame, taxonomy: DataFrame, n: int = 50) -> DataFrame:
    """Merchandise by net value of all lines, with the mean sale price."""
    return (
        _merchandise(products, taxonomy)
        .join(largest_names(names), "StockCode", "left")
        .select(
            "StockCode",
            F.col("MaxDescription").alias("Description"),
            "ProductCategory",
            F.col("UnitsSold").alias("units_sold"),
            F.col("SalesOrders").alias("orders"),
            number("GrossRevenue", 2).alias("gross_revenue"),
            number("NetAll", 2).alias("net_revenue"),
            F.round(ratio("PriceSum", "PriceCount"), 2).alias("average_unit_price"),
        )
        .filter("gross_revenue > 0")
        .orderBy(F.desc("net_revenue"), "StockCode")
        .limit(n)
    )


def merchandise_by_gross(products: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Merchandise numbered by gross revenue, greatest first."""
    rows = _merchandise(products, taxonomy).select("StockCode", "GrossRevenue")
    return numbered(rows, [F.desc_nulls_last("GrossRevenue"), F.asc("StockCode")])


def merchandise_concentration(ranked: DataFrame) -> DataFrame:
    """Top shares of gross merchandise revenue, from `merchandise_by_gross`."""
    return top_share(ranked, "GrossRevenue", C.TOP_PERCENTS, "ceil")


def merchandise_return_risk(products: DataFrame, names: DataFrame, taxonomy: DataFrame, n: int = 50) -> DataFrame:
    """Merchandise with the highest return value rate."""
    return (
        _merchandise(products, taxonomy)
        .join(largest_names(names), "StockCode", "left")
        .select(
            "StockCode",
            F.col("MaxDescription").alias("Description"),
            number("GrossRevenue", 2).alias("gross_revenue"),
            number("ReturnValue", 2).alias("return_value"),
            percent(F.abs("ReturnValue"), "GrossRevenue").alias("return_value_rate"),
            F.col("UnitsSold").alias("units_sold"),
            F.abs("ReturnedUnits").alias("returned_units"),
        )
        .filter("gross_revenue > 0")
        .orderBy(F.desc("return_value_rate"), "StockCode")
        .limit(n)
    )


def category_performance(products: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Products, units and revenue per category."""
    return (
        products.join(taxonomy.select("StockCode", "ProductCategory"), "StockCode")
        .groupBy("ProductCategory")
        .agg(
            F.count("StockCode").alias("products"),
            F.sum("UnitsSold").alias("units_sold"),
            number(F.sum("GrossRevenue"), 2).alias("gross_revenue"),
            number(F.sum("NetAll"), 2).alias("net_revenue"),
        )
        .orderBy(F.desc("net_revenue"), "ProductCategory")
    )


def monthly_merchandise(months: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Merchandise revenue and units per month, from the monthly sums of the products."""
    return (
        _merchandise(months.filter(F.col("Month").isNotNull()), taxonomy)
        .groupBy(F.col("Month").alias("sales_month"))
        .agg(number(F.sum("GrossRevenue"), 2).alias("merchandise_revenue"), F.sum("UnitsSold").alias("units_sold"))
        .orderBy("sales_month")
    )
