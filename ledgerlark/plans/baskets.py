"""Market-basket associations and scored cross-sell opportunities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.labels import association_type, commercial_action, recommendation, type_weight
from ledgerlark.functions.measures import ratio
from ledgerlark.functions.text import starts_with
from ledgerlark.operators.pairs import frequent_pairs, item_counts, multi_item_baskets
from ledgerlark.operators.picks import first_row
from ledgerlark.operators.profile import value_counts
from ledgerlark.settings import Vocabulary
from ledgerlark.storage import write_stage


def _genuine(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    return rows.join(taxonomy.filter("CommercialProduct").select("StockCode"), "StockCode", "left_semi")


def basket_members(orders: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Merchandise codes sold per invoice; `orders` is `product_orders`."""
    sold = orders.filter(F.col("HasSale") & ~starts_with(F.col("InvoiceNo"), "C"))
    return _genuine(sold.select("InvoiceNo", "StockCode"), taxonomy)


def described_members(tx: DataFrame, taxonomy: DataFrame, item: str) -> DataFrame:
    """Another item than the code (such as the description) sold per invoice.

    Made distinct before the semi join, which then sees no repeated lines.
    """
    sales = tx.filter(F.col("IsRevenueEligible") & F.col("InvoiceNo").isNotNull() & ~starts_with(F.col("InvoiceNo"), "C"))
    lines = sales.filter(F.col(item).isNotNull()).select("InvoiceNo", "StockCode", item).distinct()
    return _genuine(lines, taxonomy).select("InvoiceNo", item).distinct()


def basket_scope(members: DataFrame) -> DataFrame:
    """Members of multi-item orders, one row per invoice and item."""
    return multi_item_baskets(members, "InvoiceNo")


def basket_funnel(members: DataFrame, associations: DataFrame, item: str = "StockCode") -> DataFrame:
    """Orders, items, multi-item orders, item pairs in them, and the pairs kept as associations.

    The number of pairs follows from the basket sizes; no pair is formed.
    """
    size = F.col("_size")
    sizes = members.groupBy("InvoiceNo").agg(F.count("*").alias("_size"))
    return sizes.agg(
        F.count("*").alias("orders"),
        F.count_if(size >= 2).alias("multi_item_orders"),
        F.sum((size * (size - 1) / 2).cast("bigint")).alias("pairs"),
    ).select(
        "*",
        members.agg(F.countDistinct(item)).scalar().alias("items"),
        associations.agg(F.count("*")).scalar().alias("associations"),
    )


def basket_totals(basket: DataFrame, item: str = "StockCode") -> DataFrame:
    """Multi-item orders, items and rows in scope."""
    return basket.agg(
        F.countDistinct("InvoiceNo").alias("multi_item_orders"),
        F.countDistinct(item).alias("items"),
        F.count("*").alias("rows"),
    )


def product_associations(
    basket: DataFrame, taxonomy: DataFrame, item: str = "StockCode", min_pair_orders: int = 20, heavy_basket: int = 2000
) -> DataFrame:
    """Support, confidences and lift of item pairs bought together often enough."""
    counts = write_stage(item_counts(basket, item).filter(F.col("orders") >= min_pair_orders), "frequent_items")
    pairs = frequent_pairs(basket, counts, "InvoiceNo", item, min_pair_orders, heavy_basket)
    names = first_row(taxonomy.select("StockCode", "Description"), "StockCode").withColumnRenamed("StockCode", item)
    items = counts.join(names, item, "left") if item == "StockCode" else counts.withColumn("Description", F.col(item))

    def side(letter):
        return items.select(
            F.col(item).alias(f"Product{letter}"),
            F.col("orders").alias(f"Product{letter}Orders"),
            F.col("Description").alias(f"Product{letter}_Description"),
        )

    total = basket.agg(F.countDistinct("InvoiceNo")).scalar()
    joined = (
        pairs.select(F.col("a").alias("ProductA"), F.col("b").alias("ProductB"), F.col("n").alias("PairOrders"))
        .join(side("A"), "ProductA")
        .join(side("B"), "ProductB")
        .withColumn("_total", total)
    )
    return joined.select(
        "ProductA",
        "ProductB",
        "PairOrders",
        ratio("PairOrders", "_total").alias("Support"),
        "ProductAOrders",
        "ProductBOrders",
        ratio("PairOrders", "ProductAOrders").alias("Confidence_A_to_B"),
        ratio("PairOrders", "ProductBOrders").alias("Confidence_B_to_A"),
        ratio(F.col("PairOrders") * F.col("_total"), F.col("ProductAOrders") * F.col("ProductBOrders")).alias("Lift"),
        "ProductA_Description",
        "ProductB_Description",
    )


def top_by_lift(associations: DataFrame, n: int = 25) -> DataFrame:
    """Associations with the highest lift."""
    return (
        associations.orderBy(F.desc("Lift"), F.desc("PairOrders"), "ProductA", "ProductB")
        .limit(n)
        .drop("ProductAOrders", "ProductBOrders")
    )


def top_by_frequency(associations: DataFrame, n: int = 25) -> DataFrame:
    """Associations in the most orders."""
    return (
        associations.orderBy(F.desc("PairOrders"), F.desc("Lift"), "ProductA", "ProductB")
        .limit(n)
        .select("ProductA", "ProductB", "ProductA_Description", "ProductB_Description", "PairOrders", "Support", "Lift")
    )


def scored_opportunities(
    associations: DataFrame,
    min_orders: int = 50,
    min_lift: float = 10.0,
    min_confidence: float = 0.60,
    vocabulary: Vocabulary = Vocabulary(),
) -> DataFrame:
    """Strong associations with type and score, variants of one family included."""
    kind = association_type(F.col("ProductA_Description"), F.col("ProductB_Description"), vocabulary)
    score = F.log1p("PairOrders") * F.log1p("Lift") * F.col("Confidence_A_to_B")
    return (
        associations.filter(
            (F.col("PairOrders") >= min_orders)
            & (F.col("Lift") >= min_lift)
            & (F.col("Confidence_A_to_B") >= min_confidence)
        )
        .withColumn("AssociationType", kind)
        .withColumn("ExecutiveScore", score * type_weight(F.col("AssociationType")))
    )


_ORDER = ["ExecutiveScore", "PairOrders", "Lift"]


def cross_sell(scored: DataFrame, top: int = 50) -> DataFrame:
    """Ranked cross-sell opportunities with action and advice, without family variants."""
    order = [*[F.desc(c) for c in _ORDER], F.asc("ProductA"), F.asc("ProductB")]
    best = scored.filter(F.col("AssociationType") != C.FAMILY).orderBy(*order).limit(top)
    # At most `top` rows are left to number.
    ranked = best.withColumn("ExecutiveRank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    kind = F.col("AssociationType")
    return ranked.select(
        "ExecutiveRank", "ProductA", "ProductA_Description", "ProductB", "ProductB_Description", "AssociationType",
        commercial_action(kind).alias("CommercialAction"), "PairOrders", "Support", "Confidence_A_to_B",
        "Confidence_B_to_A", "Lift", "ExecutiveScore", recommendation(kind).alias("BusinessRecommendation"),
    )


def cross_sell_counts(opportunities: DataFrame, column: str) -> DataFrame:
    """Opportunities per association type or commercial action."""
    return value_counts(opportunities, column, "opportunities")


def cross_sell_funnel(scored: DataFrame, top: int = 50) -> DataFrame:
    """Strong associations, those left without variants, and those reported."""
    return scored.agg(
        F.count("*").alias("filtered"),
        F.count_if(F.col("AssociationType") != C.FAMILY).alias("executive"),
    ).withColumn("exported", F.least("executive", F.lit(top)))
