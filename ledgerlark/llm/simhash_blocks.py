"""SimHash fingerprints of documents and search for near ones; built-in functions only.

Terms are pairs of neighbouring words (the first word goes with nothing). Every
occurrence of a term votes with the bits of its hash, so a term weighs as often as it
occurs. Votes are counted in long sums that hold two counters of 32 bits each,
merged per task before the shuffle. A bit is 1 if more than half of the votes are.

`near_pairs` finds all fingerprints within a radius through permuted block
tables: the bits are cut into blocks, and with more blocks than the radius two
near fingerprints agree on the blocks of at least one table.

Nulls and edges: a null text counts as empty; the fingerprint of a text without
words is zero. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.ranking import global_rank
from ledgerlark.storage import write_stage

WORDS = 2  # longs in a fingerprint
RADIUS = 3
_LANES = 2
_SPACES = r"[\x20\x09-\x0D]+"


def _spread(value: Column, first: int) -> Column:
    """Two bits of a long, from `first` on, as counters of 32 bits each."""
    low = F.shiftrightunsigned(value, first).bitwiseAND(F.lit(1).cast("long"))
    high = F.shiftrightunsigned(value, first + 1).bitwiseAND(F.lit(1).cast("long"))
    return low.bitwiseOR(F.shiftleft(high, 32))


def fingerprints(texts: DataFrame, key: list[str]) -> DataFrame:
    """key and fp0, fp1, ...: the fingerprint of `text` per row of texts; `key` names a row."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), _SPACES), lambda x: x != "")

    def hashes(word: Column, i: Column) -> Column:
        before = F.get("_words", i - 1)
        return F.struct(*(F.xxhash64(F.lit(n), before, word).alias(f"h{n}") for n in range(WORDS)))

    terms = (
        texts.withColumn("_words", words)
        .select(*key, F.explode_outer(F.transform("_words", hashes)).alias("_term"))
        .select(*key, "_term.*")
    )
    sums = [
        F.sum(_spread(F.col(f"h{n}"), first)).alias(f"s{n}_{first}")
        for n in range(WORDS)
        for first in range(0, 64, _LANES)
    ]
    counts = terms.groupBy(*key).agg(F.count("h0").alias("_votes"), *sums)

    def packed(n: int) -> Column:
        total = F.lit(0).cast("long")
        for bit in range(64):
            lane = F.shiftrightunsigned(F.col(f"s{n}_{bit - bit % _LANES}"), 32 * (bit % _LANES))
            votes = lane.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
            one = F.when(2 * votes > F.col("_votes"), 1).otherwise(0).cast("long")
            total = total.bitwiseOR(F.shiftleft(one, bit))
        return total

    return counts.select(*key, *(packed(n).alias(f"fp{n}") for n in range(WORDS)))


def distance(left: list[Column], right: list[Column]) -> Column:
    """Bits in which two fingerprints differ."""
    total = F.lit(0)
    for a, b in zip(left, right):
        total = total + F.bit_count(a.bitwiseXOR(b))
    return total


def likeness(bits_apart: Column, bits: int = 64 * WORDS) -> Column:
    """Cosine of the term vectors that the distance stands for, from 0 to 1."""
    return F.greatest(F.lit(0.0), F.cos(F.lit(3.141592653589793) * bits_apart / bits))


def written(parts: list[Column]) -> Column:
    """Fingerprint as lower-case hexadecimal digits."""
    return F.concat(*(F.lpad(F.lower(F.hex(part)), 16, "0") for part in parts))


def near_pairs(table: DataFrame, queries: DataFrame, radius: int = RADIUS, spare: int = 2) -> DataFrame:
    """(query, fp0.. of the query, near0.. of the match, apart): all distinct fingerprints of `table` near those of `queries`.

    Both have distinct rows of fp0, fp1, ... The bits are cut into radius + spare blocks; there is a
    table for each choice of `spare` blocks, permuted to the front as its key.
    """
    count = radius + spare
    bits = 64 * WORDS
    edges = [bits * i // count for i in range(count + 1)]

    def masked(columns: list[Column], chosen: tuple[int, ...]) -> list[Column]:
        parts = []
        for n, column in enumerate(columns):
            mask = 0
            for block in chosen:
                for bit in range(max(edges[block], 64 * n), min(edges[block + 1], 64 * n + 64)):
                    mask |= 1 << (bit - 64 * n)
            signed = mask - (1 << 64) if mask >> 63 else mask
            parts.append(column.bitwiseAND(F.lit(signed).cast("long")))
        return parts

    names = [f"fp{n}" for n in range(WORDS)]

    def keyed(rows: DataFrame) -> DataFrame:
        columns = [F.col(name) for name in names]
        keys = [
            F.xxhash64(F.lit(number), *masked(columns, chosen))
            for number, chosen in enumerate(combinations(range(count), spare))
        ]
        return rows.select(*names, F.explode(F.array(*keys)).alias("_key"))

    left = keyed(queries)
    right = keyed(table).toDF(*(f"near{n}" for n in range(WORDS)), "_key")
    apart = distance([F.col(n) for n in names], [F.col(f"near{n}") for n in range(WORDS)])
    return (
        left.join(right, (left["_key"] == right["_key"]) & (apart <= radius))
        .select(*names, *(f"near{n}" for n in range(WORDS)), apart.alias("apart"))
        .distinct()
    )


def edited(docs: DataFrame) -> DataFrame:
    """(doc_id, place, next_place, copies, n_chars, text, edited) per distinct row of docs (doc_id, text).

    edited: the last floor(n_chars / 2) code points of the text replaced by the first as many of the
    next document's text, by ascending doc_id (nulls first, ties by a hash of the text), the first
    after the last. Places 0, 1, ... number the documents in that order. Repeated rows are one
    document with `copies`. A document sends its neighbour only the part of its text that goes there.
    """
    key = ["_id", "_none", "_hash"]
    # the same columns for both uses of the texts, so that they are shuffled once
    docs = docs.select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"),
        F.col("doc_id").isNull().alias("_none"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sizes = docs.groupBy(*key).agg(F.count("*").alias("copies"), F.max(F.char_length("text")).alias("n_chars"))
    order = [F.desc("_none"), F.asc("_id"), F.asc("_hash")]
    ranked = write_stage(global_rank(sizes, order, "_rank", "_all").withColumn("place", F.col("_rank") - 1), "places")
    after = ranked.select(
        *key, F.when(F.col("place") > 0, F.col("place") - 1).otherwise(F.col("_all") - 1).alias("place"),
        F.col("place").alias("next_place"),
    )
    owner = ranked.select(
        *(F.col(c).alias(f"{c}_to") for c in key), "place", "copies", "n_chars",
        F.floor(F.col("n_chars") / 2).cast("int").alias("_half"),
    )
    once = docs.withColumn("_copy", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))).where("_copy = 1")
    sent = once.join(after.join(owner, "place"), key).select(
        *(F.col(f"{c}_to").alias(c) for c in key), "place", "next_place", "copies", "n_chars", "_half",
        F.substr("text", F.lit(1), F.col("_half")).alias("_head"),
    )
    own = F.substr("text", F.lit(1), F.col("n_chars") - F.col("_half"))
    return once.join(sent, key).select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"), "place", "next_place", "copies", F.col("n_chars").cast("long").alias("n_chars"), "text",
        F.concat(own, "_head").alias("edited"),
    )


def compare_edited(docs: DataFrame) -> DataFrame:
    """(doc_id, copies, n_chars, edited_sha256, fp.., edited.., near_edited, near_next) per distinct row of docs.

    The fingerprints of a text, of its edited text and how alike it is to that and to the next document.
    """
    pairs = edited(docs.select("doc_id", "text")).withColumn(
        "edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)
    )
    key = ["doc_id", "place", "next_place", "copies", "n_chars", "edited_sha256"]
    texts = pairs.select(*key, F.posexplode(F.array("text", "edited")).alias("which", "text"))
    both = fingerprints(texts, [*key, "which"])
    wide = [
        F.max(F.when(F.col("which") == which, F.col(f"fp{n}"))).alias(f"{name}{n}")
        for which, name in enumerate(("fp", "edited"))
        for n in range(WORDS)
    ]
    rows = write_stage(both.groupBy(*key).agg(*wide), "document_fingerprints")
    follower = rows.select(F.col("place").alias("next_place"), *(F.col(f"fp{n}").alias(f"next{n}") for n in range(WORDS)))
    names = lambda name: [F.col(f"{name}{n}") for n in range(WORDS)]
    return rows.join(follower, "next_place").select(
        "doc_id",
        "copies",
        "n_chars",
        "edited_sha256",
        *names("fp"),
        *names("edited"),
        likeness(distance(names("fp"), names("edited"))).alias("near_edited"),
        likeness(distance(names("fp"), names("next"))).alias("near_next"),
    )


def count_near(rows: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp0, fp1, ..., n_near) for the fingerprints of `queries`: the rows within the radius, counted with `copies`."""
    names = [f"fp{n}" for n in range(WORDS)]
    sizes = rows.groupBy(*names).agg(F.sum("copies").alias("_rows"))
    pairs = near_pairs(sizes, queries.select(*names).distinct(), radius)
    there = sizes.toDF(*(f"near{n}" for n in range(WORDS)), "_rows")
    return pairs.join(there, [f"near{n}" for n in range(WORDS)]).groupBy(*names).agg(F.sum("_rows").alias("n_near"))
