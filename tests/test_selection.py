"""Exact quantiles by histogram refinement against numpy, and the shape of their plans."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import selection
from ledgerlark.operators.profile import numeric_summary

PROBABILITIES = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]


def _frame(spark, n=5000):
    """A third of the rows share one value; one group key is null."""
    rng = random.Random(3)
    rows = [
        (k, Decimal(0) if k % 3 == 0 else Decimal(rng.randint(-5000, 5000)) / 100, rng.paretovariate(0.2), (None, "a", "b")[k % 3])
        for k in range(n)
    ]
    return spark.createDataFrame(rows, "k long, v decimal(18,4), heavy double, g string").repartition(7)


@pytest.mark.parametrize("buckets", [100, 1 << 14])
def test_quantiles_equal_numpy(spark, buckets):
    df = _frame(spark)
    frame = df.toPandas().astype({"v": float})
    values = selection.long_values(df, {m: F.col(m) for m in ("v", "k", "heavy")}, ["g"])
    keys = ["g", "metric"]
    found = selection.quantiles_of(values, keys, selection.spans_of(values, keys), PROBABILITIES, buckets).collect()
    assert len(found) == 9
    for row in found:
        own = frame[frame.g.isna() if row.g is None else frame.g == row.g][row.metric].to_numpy()
        assert [row[f"q{i}"] for i in range(6)] == pytest.approx(list(np.quantile(own, PROBABILITIES)), rel=1e-12)


def test_values_that_lie_close_or_far(spark):
    for values in ([1e15, 1e15 + 0.125, 1e15 + 0.25], [5e-324, 0.0, -5e-324], [-1e308, 1e308, 1.0], [7.0],
                   [float("inf"), 1.0, 2.0], [float("-inf"), float("inf"), 0.0, 1e300], [0.1 + 1e-17 * i for i in range(9)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
        found = selection.values_at(
            long := selection.long_values(df, {"x": F.col("x")}, []), ["metric"], selection.spans_of(long, ["metric"]),
            F.sequence(F.lit(0).cast("long"), F.col("n") - 1), 50,
        )
        assert [r.value for r in found.orderBy("place").collect()] == sorted(values)


def test_no_values_have_no_quantiles(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert selection.exact_quantiles(df, {"x": F.col("x")}, [0.5]).count() == 0


def test_profile_of_money_takes_few_passes_and_no_sort_of_values(spark, monkeypatch):
    plans, write = [], selection.write_stage

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(selection, "write_stage", noted)
    rng = random.Random(9)
    rows = [(rng.choice("ab"), Decimal(int(rng.paretovariate(0.3) * 10000) % 10**13).scaleb(-4), rng.randint(1, 10**6)) for _ in range(20000)]
    df = spark.createDataFrame(rows, "g string, price decimal(18,4), id long")
    frame = df.toPandas().astype({"price": float})
    for row in numeric_summary(df, ["g"], ["price", "id"]).collect():
        own = frame[frame.g == row.g][row.column].to_numpy()
        assert [row.q25, row.q50, row.q75] == pytest.approx(list(np.quantile(own, [0.25, 0.5, 0.75])), rel=1e-12)
    passes = [p for p in plans if "BETWEEN" in p.upper() or "bucket" in p]
    assert 1 <= len(passes) <= 4
    assert not any("rangepartitioning" in p for p in plans)
