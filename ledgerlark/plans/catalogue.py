"""Product quality, product master, executive scope and anomaly audit, in this order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.labels import (
    anomaly_action, anomaly_severity, description_quality, master_return_flag, master_status,
    product_class, product_return_risk, scope_reason, value_tier,
)
from ledgerlark.functions.measures import number, ratio
from ledgerlark.functions.text import has_keyword, number_or_zero, strip, tidy
from ledgerlark.operators.profile import value_counts
from ledgerlark.operators.ranking import global_rank, mean_ranks
from ledgerlark.operators.selection import exact_quantiles


def product_quality(products: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Description quality, return risk, performance score and class of every stock code.

    A null stock code is a product of its own; order and line counts cover all
    transaction types.
    """
    known = descriptions.select(F.col("StockCode").alias("_code"), F.col("Description").alias("_text"))
    base = products.join(known, F.col("StockCode").eqNullSafe(F.col("_code")), "left").select(
        "StockCode",
        tidy(F.col("_text")).alias("Description"),
        "GrossRevenue",
        F.col("NetAll").alias("NetRevenue"),
        "UnitsSold",
        F.col("Lines").alias("SalesLines"),
        "Orders",
        "ReturnValue",
        F.abs("ReturnedUnits").alias("ReturnedUnits"),
    )
    rate = F.when(F.col("GrossRevenue") > 0, ratio(F.abs("ReturnValue"), "GrossRevenue"))
    graded = (
        base.withColumn("DescriptionQualityFlag", description_quality(F.col("Description")))
        .withColumn(
            "CommercialValidity",
            F.when(F.col("DescriptionQualityFlag") == C.COMMERCIAL_DESCRIPTION, "Valid").otherwise("Review Required"),
        )
        .withColumn("ReturnValueRate", F.round(rate, 4))
        .withColumn("ReturnRisk", product_return_risk(F.col("ReturnValueRate")))
    )
    ranked = mean_ranks(graded, {"NetRevenue": "_net_rank", "UnitsSold": "_unit_rank"})
    # Decimal arithmetic: many scores lie exactly between two roundings.
    weighted = F.lit(Decimal("0.70")) * F.col("_net_rank").cast("decimal(18,1)") + F.lit(Decimal("0.30")) * F.col(
        "_unit_rank"
    ).cast("decimal(18,1)")
    return (
        ranked.withColumn(
            "CommercialPerformanceScore", number(weighted / products.agg(F.count("*")).scalar(), 4)
        )
        .withColumn(
            "StrategicClassification",
            product_class(F.col("CommercialValidity"), F.col("NetRevenue"), F.col("ReturnValueRate")),
        )
        .drop("_net_rank", "_unit_rank")
    )


def review_list(quality: DataFrame, n: int = 15) -> DataFrame:
    """Products to review with the highest net revenue."""
    return (
        quality.filter("CommercialValidity = 'Review Required'")
        .orderBy(F.desc("NetRevenue"), "StockCode")
        .limit(n)
        .select("StockCode", "Description", number("NetRevenue").alias("NetRevenue"), "UnitsSold", "DescriptionQualityFlag")
    )


def label_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Frequencies of several label columns in one long table, from one pass."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(cells).alias("_cell")).groupBy("_cell.label", "_cell.value").agg(F.count("*").alias("products"))
    )


def product_master(quality: DataFrame, tiers: tuple = (100000, 25000, 5000)) -> DataFrame:
    """Status, priority, return flag and executive eligibility of every product."""
    clean = quality.withColumns(
        {
            "Description": tidy(F.col("Description")),
            "NetRevenue": F.coalesce("NetRevenue", F.lit(0)),
            "GrossRevenue": F.coalesce("GrossRevenue", F.lit(0)),
            "UnitsSold": F.coalesce("UnitsSold", F.lit(0)),
            "Orders": F.coalesce("Orders", F.lit(0)),
            "ReturnValueRate": number_or_zero(F.col("ReturnValueRate")),
        }
    )
    operational = has_keyword(F.col("Description"), C.MASTER_KEYWORDS)
    missing = F.col("Description") == ""
    active = (F.col("GrossRevenue") > 0) | (F.col("UnitsSold") > 0) | (F.col("Orders") > 0)
    status = F.col("ProductMasterStatus")
    return (
        clean.withColumns(
            {"IsOperationalRecord": operational, "IsMissingDescription": missing, "HasCommercialActivity": active}
        )
        .withColumn(
            "ProductMasterStatus",
            master_status(F.col("IsOperationalRecord"), F.col("IsMissingDescription"), F.col("HasCommercialActivity")),
        )
        .withColumns(
            {
                "CommercialPriority": F.when(status == C.VALIDATED, value_tier(F.col("NetRevenue"), tiers)).otherwise(
                    C.NOT_APPLICABLE
                ),
                "ReturnRiskFlag": master_return_flag(status, F.col("ReturnValueRate")),
                "IncludeInExecutiveAnalytics": status == C.VALIDATED,
            }
        )
    )


def top_validated(master: DataFrame, n: int = 20) -> DataFrame:
    """Validated products with the highest net revenue."""
    return (
        master.filter("IncludeInExecutiveAnalytics")
        .orderBy(F.desc("NetRevenue"), "StockCode")
        .limit(n)
        .select(
            "StockCode", "Description", number("NetRevenue").alias("NetRevenue"), "UnitsSold", "Orders",
            "ReturnValueRate", "CommercialPriority", "ReturnRiskFlag",
        )
    )


def product_scope(master: DataFrame, tiers: tuple = (100000, 25000, 5000)) -> DataFrame:
    """Executive scope, reason, revenue share, rank and tier; neutral values outside the scope.

    Included products sort first, so one global sort ranks them and leaves the
    others behind.
    """
    included = F.col("IsCommercialMerchandise")
    flagged = (
        master.withColumn("StockCode", strip(F.col("StockCode")))
        .withColumn("IsNonMerchandise", F.coalesce(F.col("StockCode").isin(C.NON_MERCHANDISE_CODES), F.lit(False)))
        .withColumn(
            "IsCommercialMerchandise",
            (F.col("ProductMasterStatus") == C.VALIDATED) & ~F.col("IsNonMerchandise"),
        )
        .withColumn("ExecutiveScope", F.when(included, "Included").otherwise("Excluded"))
        .withColumn(
            "ScopeReason", scope_reason(included, F.col("ProductMasterStatus"), F.col("IsNonMerchandise"))
        )
    )
    ranked = global_rank(
        flagged, [included.desc(), F.col("NetRevenue").desc(), F.col("StockCode").asc()], "_at"
    )
    total = ranked.filter(included).agg(F.sum("NetRevenue").cast("double")).scalar()
    return ranked.withColumns(
        {
            "RevenueShare": F.when(included, F.try_divide(number("NetRevenue"), total)).otherwise(0.0),
            "RevenueRank": F.when(included, F.col("_at")).otherwise(0),
            "ExecutiveProductTier": F.when(included, value_tier(F.col("NetRevenue"), tiers)).otherwise(C.NOT_APPLICABLE),
        }
    ).drop("_at")


def scope_totals(scope: DataFrame) -> DataFrame:
    """Included and excluded products, and the KPIs of the included ones."""
    included = F.col("IsCommercialMerchandise")
    return scope.agg(
        F.count("*").alias("products"),
        F.count_if(included).alias("included"),
        F.count_if(~included).alias("excluded"),
        number(F.sum(F.when(included, F.col("NetRevenue")))).alias("net_revenue"),
        F.sum(F.when(included, F.col("UnitsSold"))).alias("units_sold"),
    )


def tier_counts(scope: DataFrame) -> DataFrame:
    """Included products per executive tier."""
    return value_counts(scope.filter("IsCommercialMerchandise"), "ExecutiveProductTier", "products")


def top_scope(scope: DataFrame, n: int = 20) -> DataFrame:
    """Included products by rank."""
    return scope.filter((F.col("RevenueRank") >= 1) & (F.col("RevenueRank") <= n)).select(
        "RevenueRank", "StockCode", "Description", number("NetRevenue").alias("NetRevenue"), "UnitsSold", "Orders",
        "RevenueShare", "ReturnValueRate", "ExecutiveProductTier",
    )


_FLAGS = [
    "DescriptionAnomaly", "ReturnAnomaly", "HighRevenueAnomaly", "HighVolumeLowValueAnomaly",
    "ExtremeRevenuePerOrder", "ExtremeRevenuePerUnit",
]


def product_anomalies(scope: DataFrame) -> DataFrame:
    """Six anomaly flags, score, severity and action of the included products."""

    def per(count):
        return F.when(F.col(count) > 0, ratio("NetRevenue", count)).otherwise(F.lit(0.0))

    audited = scope.filter("IsCommercialMerchandise").withColumns(
        {
            "Description": tidy(F.col("Description")),
            "RevenuePerOrder": per("Orders"),
            "RevenuePerUnit": per("UnitsSold"),
            "ReturnValueRate": F.greatest("ReturnValueRate", F.lit(0.0)),
        }
    )
    metrics = ["NetRevenue", "UnitsSold", "RevenuePerOrder", "RevenuePerUnit"]
    edges = exact_quantiles(audited, {m: F.col(m) for m in metrics}, [0.95, 0.99])
    # One row: the thresholds, read as a scalar subquery.
    limits = edges.agg(
        F.struct(
            *[
                F.max(F.when(F.col("metric") == m, F.col(q))).alias(m)
                for m, q in zip(metrics, ["q0", "q0", "q1", "q1"])
            ]
        )
    ).scalar()

    def over(metric):
        return number(metric) >= F.col("_limit")[metric]

    described = has_keyword(F.col("Description"), C.ANOMALY_KEYWORDS)
    flagged = (
        audited.withColumn("_limit", limits)
        .withColumn("DescriptionAnomaly", described)
        .withColumns(
            {
                "ReturnAnomaly": F.col("ReturnValueRate") >= 0.30,
                "HighRevenueAnomaly": over("NetRevenue") & F.col("DescriptionAnomaly"),
                "HighVolumeLowValueAnomaly": over("UnitsSold") & (F.col("NetRevenue") <= 0),
                "ExtremeRevenuePerOrder": over("RevenuePerOrder"),
                "ExtremeRevenuePerUnit": over("RevenuePerUnit"),
            }
        )
        .drop("_limit")
    )
    score = sum(F.col(flag).cast("bigint") for flag in _FLAGS)
    return (
        flagged.withColumn("AnomalyScore", score)
        .withColumn("AnomalySeverity", anomaly_severity(F.col("AnomalyScore")))
        .withColumn(
            "RecommendedAction",
            anomaly_action(F.col("AnomalySeverity"), F.col("DescriptionAnomaly"), F.col("ReturnAnomaly")),
        )
    )


def anomaly_totals(anomalies: DataFrame) -> DataFrame:
    """Audited products, those to investigate, and hits per flag."""
    return anomalies.agg(
        F.count("*").alias("audited"),
        F.count_if(F.col("AnomalyScore") > 0).alias("to_investigate"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in _FLAGS],
    )


def severity_counts(anomalies: DataFrame) -> DataFrame:
    """Audited products per severity."""
    return value_counts(anomalies, "AnomalySeverity", "products")


def top_anomalies(anomalies: DataFrame, n: int = 30) -> DataFrame:
    """Flagged products by score and net revenue."""
    return (
        anomalies.filter("AnomalyScore > 0")
        .orderBy(F.desc("AnomalyScore"), F.desc("NetRevenue"), "StockCode")
        .limit(n)
        .select(
            "StockCode", "Description", number("NetRevenue").alias("NetRevenue"), "UnitsSold", "Orders",
            "ReturnValueRate", "RevenuePerOrder", "RevenuePerUnit", "AnomalyScore", "AnomalySeverity",
            "RecommendedAction",
        )
    )
