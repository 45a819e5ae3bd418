from ledgerlark.operators.profile import numeric_summary


def test_a_column_without_values_keeps_its_row(spark):
    rows = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", 2.0, 5.0)], "g string, x double, y double")
    found = {(r.g, r.column): r for r in numeric_summary(rows, ["g"], ["x", "y"]).collect()}
    assert set(found) == {("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")}
    assert found["a", "y"]["count"] == 0 and found["a", "y"].q50 is None and found["a", "x"].q50 == 2.0
