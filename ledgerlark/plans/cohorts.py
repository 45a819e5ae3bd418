"""Customer cohorts by month of first purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.measures import number, ratio


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Active customers, retention and revenue per cohort month and months since.

    Sales are merged to one row per customer and month before the window, so
    its groups hold at most one row per month of history.
    """
    active = (
        orders.filter(F.col("IsRevenueEligible") & F.col("CustomerID").isNotNull())
        .groupBy("CustomerID", "Month")
        .agg(F.sum("Revenue").alias("Revenue"))
    )
    joined = active.withColumn("CohortMonth", F.min("Month").over(Window.partitionBy("CustomerID")))
    months = (F.year("Month") - F.year("CohortMonth")) * 12 + F.month("Month") - F.month("CohortMonth") + 1
    cells = joined.groupBy("CohortMonth", months.cast("bigint").alias("CohortIndex")).agg(
        F.count("*").alias("ActiveCustomers"), number(F.sum("Revenue")).alias("Revenue")
    )
    # One row per month pair of the history.
    size = F.max(F.when(F.col("CohortIndex") == 1, F.col("ActiveCustomers"))).over(Window.partitionBy("CohortMonth"))
    return (
        cells.withColumn("CohortSize", size)
        .withColumn("RetentionRate", ratio("ActiveCustomers", "CohortSize") * 100)
        .select("CohortMonth", "CohortIndex", "ActiveCustomers", "CohortSize", "RetentionRate", "Revenue")
    )


def cohort_overview(cohorts: DataFrame) -> DataFrame:
    """Size and first-month revenue per cohort."""
    return cohorts.filter("CohortIndex = 1").select("CohortMonth", "CohortSize", "Revenue").orderBy("CohortMonth")


def weighted_retention(cohorts: DataFrame, months: tuple = (1, 2, 3, 6, 12)) -> DataFrame:
    """Retention at chosen months over all cohorts that reach them."""
    return (
        cohorts.filter(F.col("CohortIndex").isin(*months))
        .groupBy("CohortIndex")
        .agg((ratio(F.sum("ActiveCustomers"), F.sum("CohortSize")) * 100).alias("retention"))
        .orderBy("CohortIndex")
    )


def ranked_cohorts(cohorts: DataFrame, best: bool = True, month: int = 3, n: int = 10) -> DataFrame:
    """Cohorts with the best or the lowest retention at one month."""
    rate = F.desc("RetentionRate") if best else F.asc("RetentionRate")
    return (
        cohorts.filter(F.col("CohortIndex") == month)
        .orderBy(rate, "CohortMonth")
        .limit(n)
        .select("CohortMonth", "CohortSize", "ActiveCustomers", "RetentionRate")
    )
