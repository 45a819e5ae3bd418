"""Connected components of a graph given as edges, by alternating stars.

Every round is two joins and two minima over the edges; its result is written
to the shared folder, so a lost executor never repeats earlier rounds. The
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.storage import write_stage


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge and is not the least of its component.

    `edges` has the long columns a and b, in any direction, with repeats and
    loops; nulls are not allowed. `root` is the least node of the component.
    """
    stars = write_stage(_ordered(edges.select("a", "b")), "stars")
    state = _state(stars)
    while state[0]:
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select("b", "low").where("b != low").toDF("a", "b")
        stars = write_stage(_ordered(small.unionAll(least.toDF("a", "b"))), "stars")
        before, state = state, _state(stars)
        if before == state:
            break
    return stars.toDF("node", "root")
