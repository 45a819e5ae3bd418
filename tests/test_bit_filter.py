from pyspark.sql import functions as F

from ledgerlark.operators.bit_filter import BitFilter


def test_every_hash_is_found_and_few_others(spark):
    rows = spark.range(20000).select("id", F.xxhash64("id").alias("h"))
    held = BitFilter(rows.where("id < 1000"), "h")
    found = rows.where(held.may_hold(F.col("h")))
    assert found.where("id < 1000").count() == 1000
    assert 1000 <= found.count() < 2200


def test_a_full_table_lets_all_pass(spark):
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    held = BitFilter(rows, "h", 1)
    assert rows.where(held.may_hold(F.col("h"))).count() == 5000
    assert rows.where(BitFilter(rows.limit(0), "h").may_hold(F.col("h"))).count() == 0
