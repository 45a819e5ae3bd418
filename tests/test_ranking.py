"""Global ranks, running totals, buckets and shares against pandas and plain windows."""

import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlark.operators import ranking
from ledgerlark.storage import write_stage


def _skewed(spark, n=5000):
    """A third of the rows share one value."""
    rng = random.Random(3)
    rows = [(k, Decimal(0) if k % 3 == 0 else Decimal(rng.randint(-5000, 5000)) / 100) for k in range(n)]
    return spark.createDataFrame(rows, "k long, v decimal(18,4)").repartition(7)


def test_global_rank_equals_plain_window(spark):
    df = _skewed(spark)
    order = [F.col("v").desc(), F.col("k").asc()]
    ranked = ranking.global_rank(df, order, "at", "n")
    plain = df.withColumn("want", F.row_number().over(Window.orderBy(*order))).select("k", "want")
    assert ranked.join(plain, "k").filter("at <> want OR n <> 5000").count() == 0
    assert ranked.count() == 5000


def test_running_total_equals_plain_window(spark):
    df = _skewed(spark)
    order = [F.col("v").desc(), F.col("k").asc()]
    run = ranking.running_total(df, order, "v", "total", "at")
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = df.select("k", F.sum("v").over(window).alias("want"))
    assert run.join(plain, "k").filter("total <> want").count() == 0


def test_rank_of_empty_table(spark):
    empty = _skewed(spark).filter("k < 0")
    assert ranking.global_rank(empty, [F.col("k").asc()], "at", "n").count() == 0


@pytest.mark.parametrize("n", [1, 5, 7, 12, 99, 100, 101, 1333])
def test_rank_bucket_equals_qcut(spark, n):
    df = spark.range(1, n + 1).withColumn("n", F.lit(n).cast("long"))
    for q in (4, 5):
        ours = [r[0] for r in df.orderBy("id").select(ranking.rank_bucket(F.col("id"), F.col("n"), q)).collect()]
        if n == 1:
            assert ours == [1]
            continue
        theirs = pd.qcut(pd.Series(range(1, n + 1)), q, labels=range(1, q + 1)).astype(int).tolist()
        assert ours == theirs


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10, 11, 1002])
def test_ntile_bucket_equals_ntile(spark, n):
    df = spark.range(1, n + 1).withColumn("n", F.lit(n).cast("long"))
    both = df.select(
        ranking.ntile_bucket(F.col("id"), F.col("n"), 4).alias("ours"), F.ntile(4).over(Window.orderBy("id")).alias("want")
    )
    assert both.filter("ours <> want").count() == 0


def test_top_share_rules(spark):
    df = spark.createDataFrame([(k, float(v)) for k, v in enumerate([50, 20, 10, 5, 5, 4, 3, 1, 1, 1, 0])], "k long, v double")
    stored = write_stage(ranking.numbered(df, [F.desc("v"), F.asc("k")]), "test_numbered")
    ceil = ranking.top_share(stored, "v", [1, 10, 20], "ceil", suffix="").first()
    floor = ranking.top_share(stored, "v", [1, 10, 20], "floor", suffix="").first()
    assert list(ceil) == [50.0, 70.0, 80.0]
    assert list(floor) == [50.0, 50.0, 70.0]
    leading = ranking.top_share(stored, "v", [50], "ceil", suffix="", leading=F.col("v") > 3).first()
    assert list(leading) == [round(100 * 80 / 94, 2)]


def test_mean_ranks_equal_pandas(spark):
    df = _skewed(spark).withColumn("u", (F.col("k") % 17))
    got = ranking.mean_ranks(df, {"v": "rv", "u": "ru"}).toPandas().sort_values("k")
    assert got.rv.tolist() == got.v.astype(float).rank(method="average").tolist()
    assert got.ru.tolist() == got.u.rank(method="average").tolist()


def test_mean_rank_of_null_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 5)], "k long, v long")
    assert {r.k: r.r for r in ranking.mean_ranks(df, {"v": "r"}).collect()} == {1: 1.5, 2: None, 3: 1.5}
