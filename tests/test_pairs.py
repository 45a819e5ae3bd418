"""Frequent pairs against brute force, with and without heavy baskets."""

import random
from collections import Counter
from itertools import combinations

import pytest

from ledgerlark.operators import pairs
from ledgerlark.operators.pairs import (
    PairSketch, frequent_pairs, item_counts, light_pairs, multi_item_baskets, pair_rows,
)
from ledgerlark.storage import write_stage


def _baskets(seed, baskets=120, items=30, giants=0):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(items)]
    rows = set()
    for basket in range(baskets):
        size = items if basket < giants else rng.randint(1, 8)
        picked = range(items) if basket < giants else rng.choices(range(items), weights, k=size)
        rows |= {(f"b{basket}", f"i{item:02d}") for item in picked}
    return sorted(rows)


def _brute_force(rows, threshold):
    groups = {}
    for basket, item in rows:
        groups.setdefault(basket, []).append(item)
    found = Counter(pair for items in groups.values() for pair in combinations(sorted(items), 2))
    return {pair: n for pair, n in found.items() if n >= threshold}


# One giant basket can hold a third of all rows; several giants outnumber the threshold.
@pytest.mark.parametrize("giants", [0, 1, 3, 6, 12])
@pytest.mark.parametrize("heavy", [1, 4, 7, 2000])
def test_frequent_pairs(spark, giants, heavy):
    rows = _baskets(giants * 31 + heavy, giants=giants)
    members = spark.createDataFrame(rows, "basket string, item string")
    counts = item_counts(members, "item").filter("orders >= 5")
    got = frequent_pairs(members, write_stage(counts, "test_items"), "basket", "item", 5, heavy)
    assert {(r.a, r.b): r.n for r in got.collect()} == _brute_force(rows, 5)


@pytest.mark.parametrize("giants", [0, 6])
def test_frequent_pairs_with_a_sketch(spark, giants):
    rows = _baskets(giants + 1, baskets=400, items=60, giants=giants)
    members = spark.createDataFrame(rows, "basket string, item string")
    counts = item_counts(members, "item").filter("orders >= 12")
    got = frequent_pairs(members, write_stage(counts, "test_items"), "basket", "item", 12, 20, sketch_from=0)
    assert {(r.a, r.b): r.n for r in got.collect()} == _brute_force(rows, 12)


def test_the_sketch_drops_most_rows_and_no_frequent_pair(spark):
    rng = random.Random(4)
    rows = sorted({(f"b{b}", f"i{rng.randrange(3000):04d}", 0) for b in range(3000) for _ in range(10)}
                  | {(f"b{b}", f"j{j}", 0) for b in range(0, 3000, 50) for j in range(4)})
    members = write_stage(spark.createDataFrame(rows, "basket string, item string, heavy_orders bigint"), "test_members")
    met = pairs._met(members)
    before = pair_rows(members)
    assert before == met.count()
    kept = PairSketch(met, 20, before).may_reach(met)
    frequent = _brute_force([row[:2] for row in rows], 20)
    assert {(r.a, r.b): r.n for r in light_pairs(members, 20, 0).collect()} == frequent and len(frequent) == 6
    assert sum(frequent.values()) <= kept.count() < before / 20


def test_light_pairs_meet_the_bound(spark):
    rows = [(b, i, int(i[1:]) % 4) for b, i in _baskets(5)]
    members = spark.createDataFrame(rows, "basket string, item string, heavy_orders bigint")
    possible = _brute_force([row[:2] for row in rows], 1)
    expected = {p: n for p, n in possible.items() if n + min(int(i[1:]) % 4 for i in p) >= 6}
    assert {(r.a, r.b): r.n for r in light_pairs(members, 6).collect()} == expected
    assert 0 < len(expected) < len(possible)


def test_multi_item_baskets(spark):
    members = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "1")], "basket string, item string")
    assert sorted(r.basket for r in multi_item_baskets(members, "basket").collect()) == ["x", "x"]


def test_light_baskets_are_dealt_by_the_pairs_they_make(spark, monkeypatch):
    rows = [(b, i, 0) for b, i in _baskets(3)]
    members = write_stage(spark.createDataFrame(rows, "basket string, item string, heavy_orders bigint"), "test_members")
    expected = _brute_force([row[:2] for row in rows], 4)
    for sketch_from in (0, pairs.SKETCH_FROM):
        assert {(r.a, r.b): r.n for r in light_pairs(members, 4, sketch_from).collect()} == expected
        monkeypatch.setattr(pairs, "SPREAD_FROM", 1)
        monkeypatch.setattr(pairs, "PAIRS_PER_TASK", 50)
        spread = light_pairs(members, 4, sketch_from)
        assert {(r.a, r.b): r.n for r in spread.collect()} == expected
        tasks = pair_rows(members) // 50 + 1
        assert f", {tasks}), REPARTITION_BY_NUM" in spread._jdf.queryExecution().executedPlan().toString()
