"""Frequent item pairs of baskets.

A basket of m items holds m*(m-1)/2 pairs, so one huge basket could outgrow any
task. The counting is exact and stays even:

* Items in fewer baskets than the threshold cannot be in a frequent pair and
  are dropped before pairing.
* Light baskets (up to `heavy` remaining items) are joined with themselves. Only
  pairs that can still reach the threshold are kept: those whose light count plus
  the heavy baskets of the rarer item are enough.
* In heavy baskets, a pair can only reach the threshold through heavy baskets
  alone when both items are in that many heavy baskets. Those items are paired
  block by block: items are hashed to blocks of about `heavy` items and each
  pair of blocks is a join key of its own, so the work spreads over tasks.
* Where light baskets hold very many pairs, a count-min table of pair hashes is
  taken first: one counter per hash bucket, merged over all tasks. A counter is
  never below the count of a pair in it, so a pair in a bucket that stays below
  what it needs is dropped before the exact shuffle, and no other one.
* Any other pair needs light baskets too. It is looked up, not generated: the
  item of the pair with fewer heavy baskets (fewer than the threshold) leads to
  them, and the other item is tested there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.bit_filter import BITS_PER_HASH, BitFilter
from ledgerlark.storage import write_stage

#: (basket, pair) rows from which pairs are sketched first: the join then runs twice, the shuffle carries less.
SKETCH_FROM = 1 << 26
#: (basket, pair) rows of a task, about. Baskets are dealt by the pairs they make, not by their bytes, from SPREAD_FROM on.
PAIRS_PER_TASK = 1 << 20
SPREAD_FROM = 1 << 24


def multi_item_baskets(members: DataFrame, basket: str) -> DataFrame:
    """Rows of baskets with at least two items; `members` holds distinct (basket, item) rows."""
    several = members.groupBy(basket).agg(F.count("*").alias("_size")).filter("_size >= 2").select(basket)
    return members.join(write_stage(several, "multi_item_orders"), basket, "left_semi")


def item_counts(members: DataFrame, item: str) -> DataFrame:
    """Number of baskets per item."""
    return members.groupBy(item).agg(F.count("*").alias("orders"))


def _met(members: DataFrame) -> DataFrame:
    """One row per light basket and pair in it (a < b); `heavy` bounds what heavy baskets can add to the pair."""
    left = members.select("basket", F.col("item").alias("a"), F.col("heavy_orders").alias("ha"))
    right = members.select("basket", F.col("item").alias("b"), F.col("heavy_orders").alias("hb"))
    return left.join(right, "basket").filter("a < b")


class PairSketch:
    """Count-min table of the pairs of `_met`: `DEPTH` counters for every pair, each shared with other pairs.

    Only buckets that reach what some pair in them needs are kept, as bit tables of bounded size.
    """

    DEPTH = 2

    def __init__(self, met: DataFrame, threshold: int, pairs: int):
        """`pairs` is about the number of rows of `met`; buckets are so many that few reach the threshold by chance."""
        self.buckets = 1 << min(26, max(10, (4 * pairs // threshold).bit_length()))
        rows = met.select(
            F.least("ha", "hb").alias("more"),
            F.explode(F.array(*[F.struct(F.lit(d).alias("d"), self.bucket(d).alias("bucket")) for d in range(self.DEPTH)])).alias("_at"),
        )
        counters = rows.groupBy("_at.d", "_at.bucket").agg(F.count("*").alias("n"), F.max("more").alias("more"))
        live = write_stage(counters.filter(F.col("n") + F.col("more") >= threshold).select("d", "bucket"), "live_pairs")
        self.tables = [
            BitFilter(live.filter(F.col("d") == d).select("bucket"), "bucket", self.buckets // BITS_PER_HASH)
            for d in range(self.DEPTH)
        ]

    def bucket(self, depth: int):
        return F.xxhash64(F.lit(depth), "a", "b").bitwiseAND(F.lit(self.buckets - 1).cast("long"))

    def may_reach(self, met: DataFrame) -> DataFrame:
        """Rows of pairs that may reach the threshold: all that do, and a few others."""
        for depth, table in enumerate(self.tables):
            met = met.filter(table.may_hold(self.bucket(depth)))
        return met


def pair_rows(members: DataFrame) -> int:
    """Number of (basket, pair) rows of light baskets."""
    sizes = members.groupBy("basket").agg(F.count("*").alias("m"))
    return sizes.agg(F.coalesce(F.sum(F.col("m") * (F.col("m") - 1) / 2), F.lit(0)).cast("long")).first()[0]


def light_pairs(members: DataFrame, threshold: int, sketch_from: int = SKETCH_FROM) -> DataFrame:
    """Pair counts of baskets that are small enough to be joined with themselves.

    `heavy_orders` of a member is the number of heavy baskets with its item. It
    bounds what heavy baskets can add, so a pair below the threshold even with
    that is dropped in the same job, before anything is written. From `sketch_from`
    (basket, pair) rows on, most of these pairs are dropped before the shuffle. A task meets about
    `PAIRS_PER_TASK` of them, so that what it counts before the shuffle fits its memory.
    """
    rows = pair_rows(members)
    if rows >= SPREAD_FROM:
        members = members.repartition(rows // PAIRS_PER_TASK + 1, "basket")
    met = _met(members)
    if rows >= sketch_from:
        met = PairSketch(met, threshold, rows).may_reach(met)
    counted = met.groupBy("a", "b", "ha", "hb").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") + F.least("ha", "hb") >= threshold)


def _blocked_pairs(members: DataFrame, heavy: int) -> DataFrame:
    """Pair counts of heavy baskets, one join key per basket and pair of blocks."""
    blocks = F.ceil(F.col("size") / heavy)
    placed = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("item"), F.col("blocks"))
    )
    left = placed.select(
        "basket", F.col("item").alias("x"), F.col("block").alias("i"),
        F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"),
    )
    right = placed.select(
        "basket", F.col("item").alias("y"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"),
        F.col("block").alias("j"),
    )
    met = left.join(right, ["basket", "i", "j"]).filter("i < j OR x < y")
    return met.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("n"))


def _looked_up_pairs(light: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """Heavy-basket counts of light pairs that only light and heavy baskets together can carry."""
    fewer = F.least("ha", "hb")
    open_pairs = light.filter((fewer > 0) & (fewer < threshold))
    a_leads = F.col("ha") <= F.col("hb")
    led = open_pairs.select(
        "a", "b", F.when(a_leads, F.col("a")).otherwise(F.col("b")).alias("item"),
        F.when(a_leads, F.col("b")).otherwise(F.col("a")).alias("other"),
    )
    places = led.join(members.select("item", "basket"), "item").select("a", "b", "basket", "other")
    hits = places.join(members.select("basket", F.col("item").alias("other")), ["basket", "other"])
    return hits.groupBy("a", "b").agg(F.count("*").alias("n"))


def frequent_pairs(
    members: DataFrame, frequent: DataFrame, basket: str, item: str, threshold: int, heavy: int = 2000,
    sketch_from: int = SKETCH_FROM,
) -> DataFrame:
    """Item pairs (a < b) in at least `threshold` baskets, with their exact count `n`.

    `members` holds distinct (basket, item) rows, `frequent` the items in at
    least `threshold` baskets as a stage table: a side that is a plain scan
    lets a join split the partitions of an item that is in most baskets.
    """
    rows = members.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    chosen = frequent.select(F.col(item).alias("item"))
    rows = write_stage(rows.join(chosen, "item", "left_semi"), "pair_members")
    sizes = write_stage(
        rows.groupBy("basket").agg(F.count("*").alias("size")).filter(F.col("size") > heavy), "heavy_baskets"
    )
    in_heavy = write_stage(rows.join(sizes, "basket"), "heavy_members")
    counts = write_stage(in_heavy.groupBy("item").agg(F.count("*").alias("heavy_orders")), "heavy_items")
    in_light = rows.join(sizes, "basket", "left_anti").join(counts, "item", "left").na.fill(0, ["heavy_orders"])
    light = write_stage(light_pairs(in_light, threshold, sketch_from), "light_pairs")
    supported = counts.filter(F.col("heavy_orders") >= threshold).select("item")
    blocked = _blocked_pairs(in_heavy.join(supported, "item", "left_semi"), heavy)
    looked_up = _looked_up_pairs(light, in_heavy, threshold)
    return (
        light.select("a", "b", "n")
        .unionByName(blocked)
        .unionByName(looked_up)
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= threshold)
    )
