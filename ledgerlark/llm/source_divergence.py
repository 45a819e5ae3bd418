"""How the word use of sources differs: term shares per source, compared pairwise and with their language.

Terms are counted by task. What is shuffled is a fixed-width digest per term, never its
text: first with the number of documents, which tells the digests that enough documents
hold; then, for those alone, with the counts per source. For kept digests the smallest
and the greatest text are taken: where the two differ, several terms share a digest, and
that digest alone is counted again by text. Text is joined back to the rows of the
result only. A bit table of the kept digests, of bounded size, drops the rows of other
terms before each shuffle; an exact join follows.

A term's share in a group is 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)),
with N occurrences of the V kept terms of the language in the group. The distance
of two sources is the sum of the absolute differences of all V shares. Terms that
a source lacks have one and the same share there, so they need no rows: a pair of
sources meets only at terms that both hold, and the rest follows from how often
each share occurs in a source.

Nulls: null text, language and source count as empty text. A group without kept
terms has the same share for all of them; a language without kept terms has
distances of zero and no term rows. Repeated rows are documents of their own; an
empty table has an empty result. Other columns of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.bit_filter import BitFilter
from ledgerlark.storage import write_stage

LEAST_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
_DIGEST_BITS = 64
_HELD_TERMS = 1 << 19
_HELD_COUNTS = 1 << 22
_PIECE_BYTES = 1 << 22
_SALTS = 32
_GROUP, _TERM = ["lang", "source"], ["lang", "digest", "split"]


def _letters() -> bytes:
    """Table that lowers A-Z, keeps a-z and all bytes of other characters, and blanks the rest."""
    kept = {*range(ord("a"), ord("z") + 1), *range(128, 256)}
    return bytes(b if b in kept else b + 32 if ord("A") <= b <= ord("Z") else 32 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a blanked text, by pieces of bounded size that end between words."""
    start = 0
    while len(text) - start > _PIECE_BYTES:
        end = text.find(b" ", start + _PIECE_BYTES)
        if end < 0:
            break
        yield text[start:end].split()
        start = end
    yield text[start:].split()


class _Part:
    """Counts of the terms of one language in a part of a task."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.sources: dict[str, int] = {}
        self.docs: list[np.ndarray] = []  # per document its source and terms in one number, and their counts
        self.size = 0

    def add(self, source: str, text: bytes) -> None:
        terms, number, found = self.terms, self.sources.setdefault(source, len(self.sources)), []
        for words in _pieces(text):
            places = [terms.setdefault(word, len(terms)) for word in words]
            found.append(np.unique(np.array(places, np.int64), return_counts=True))
        term = np.concatenate([f[0] for f in found])
        own, place = np.unique(term, return_inverse=True)
        n = np.bincount(place, np.concatenate([f[1] for f in found])).astype(np.int64)
        self.docs.append(np.stack([own << 32 | number, n[: len(own)]]))
        self.size += len(own)

    def rows(self, lang: str) -> pa.RecordBatch:
        """One row per term: its documents, and its sources with their counts."""
        key, n = np.concatenate(self.docs, axis=1)
        docs = np.bincount(key >> 32, minlength=len(self.terms))
        pair, place = np.unique(key, return_inverse=True)
        counts = np.bincount(place, n).astype(np.int64)
        term, source = pair >> 32, pair & 0xFFFFFFFF
        cuts = pa.array(np.searchsorted(term, np.arange(len(self.terms) + 1)).astype(np.int32))
        names = pa.array(list(self.sources), pa.string()).take(pa.array(source))
        columns = [
            pa.array([lang] * len(self.terms), pa.string()), pa.array(list(self.terms), pa.binary()), pa.array(docs, pa.int64()),
            pa.ListArray.from_arrays(cuts, names), pa.ListArray.from_arrays(cuts, pa.array(counts)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "docs", "sources", "counts"])


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, term, docs, sources, counts) of docs (lang, source, text): by part of a task, not yet merged.

    `docs` is the number of documents with the term, `counts` has its occurrences in each of `sources`.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, parts = _letters(), {}
        for batch in batches:
            langs, sources, texts = batch.columns
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts.cast(pa.binary())):
                part = parts.setdefault(lang or "", _Part())
                part.add(source or "", (text.as_py() or b"").translate(table))
                if len(part.terms) >= _HELD_TERMS or part.size >= _HELD_COUNTS:
                    yield parts.pop(lang or "").rows(lang or "")
        yield from (part.rows(lang) for lang, part in parts.items())

    parts = docs.select("lang", "source", "text").mapInArrow(
        counted, "lang string, term binary, docs long, sources array<string>, counts array<long>"
    )
    return parts.withColumn("term", F.col("term").cast("string"))


def _kept(parts: DataFrame, least_docs: int, *term: str) -> DataFrame:
    """Terms of each language that enough documents hold."""
    return parts.groupBy("lang", *term).agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")


def _in_sources(parts: DataFrame, kept: DataFrame, *term: str) -> DataFrame:
    """(lang, source, term..., n) of the kept terms.

    A part of a task holds a term once per source, so rows of the most frequent term grow with the parts only.
    """
    each = parts.select("lang", *term, F.explode(F.arrays_zip("sources", "counts")).alias("_of"))
    each = each.select("lang", *term, F.col("_of.sources").alias("source"), F.col("_of.counts").alias("n"))
    merged = each.repartition("lang", *term).groupBy(*_GROUP, *term).agg(F.sum("n").alias("n"))
    return merged.join(kept, ["lang", *term], "left_semi")


def kept_terms(
    counted: DataFrame, least_docs: int = LEAST_DOCS, digest_bits: int = _DIGEST_BITS
) -> tuple[DataFrame, DataFrame]:
    """(lang, source, digest, split, n) per group and kept term, and (lang, digest, split, term) per kept term.

    `counted` is `count_terms` as a stage table. `split` is empty, or the text of a term whose digest another
    kept digest's term has too.
    """
    digest = F.shiftrightunsigned(F.xxhash64("term"), _DIGEST_BITS - digest_bits)
    parts = counted.withColumn("digest", digest)
    kept = write_stage(_kept(parts.select("lang", "digest", "docs"), least_docs, "digest"), "kept_digests")
    held = BitFilter(kept.select(F.xxhash64("lang", "digest").alias("h")), "h")
    parts = parts.where(held.may_hold(F.xxhash64("lang", "digest")))
    counts = write_stage(_in_sources(parts, kept, "digest"), "digest_counts")
    names = parts.groupBy("lang", "digest").agg(F.min("term").alias("term"), F.max("term").alias("_last"))
    names = write_stage(names.join(kept, ["lang", "digest"], "left_semi"), "term_names")
    shared = names.where("term != _last").select("lang", "digest")
    clean = names.where("term = _last").select("lang", "digest", F.lit("").alias("split"), "term")
    if shared.isEmpty():
        return counts.withColumn("split", F.lit("")), clean
    apart = write_stage(parts.join(shared, ["lang", "digest"], "left_semi").withColumnRenamed("term", "split"), "shared_digests")
    kept_apart = write_stage(_kept(apart, least_docs, "digest", "split"), "kept_texts")
    whole = counts.join(shared, ["lang", "digest"], "left_anti").withColumn("split", F.lit(""))
    texts = kept_apart.withColumn("term", F.col("split"))
    return whole.unionByName(_in_sources(apart, kept_apart, "digest", "split")), clean.unionByName(texts)


def _share(count: str | int, prior: int = PRIOR, scale: int = SCALE) -> Column:
    """Share of a term with this count among `total` occurrences of `terms` kept terms; exact at any size."""
    held = F.lit(count) if isinstance(count, int) else F.col(count)
    above = (held.cast("decimal(18,0)") + prior) * F.lit(scale).cast("decimal(10,0)")
    below = F.col("total").cast("decimal(18,0)") + F.col("terms").cast("decimal(18,0)") * prior
    # a language without terms needs no shares, only a divisor
    return 1 + F.call_function("div", above, F.greatest(below, F.lit(1).cast("decimal(18,0)")))


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, digest_bits: int = _DIGEST_BITS
) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (lang, source, text).

    Part `pair`: every other source of the language with its distance. Part `term`: the
    `top_terms` terms whose share in the source is furthest above that in the language.
    """
    counted = write_stage(count_terms(docs), "term_counts")
    kept, names = kept_terms(counted, least_docs, digest_bits)
    kept = write_stage(kept, "kept_terms")
    in_lang = write_stage(kept.groupBy(*_TERM).agg(F.sum("n").alias("n")), "language_terms")
    langs = in_lang.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("all"))
    empty = F.lit("")
    groups = docs.select(*[F.coalesce(F.col(c), empty).alias(c) for c in _GROUP]).distinct()
    totals = kept.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    bases = groups.join(totals, _GROUP, "left").join(langs.drop("all"), "lang", "left").na.fill(0, ["total", "terms"])
    bases = write_stage(bases.withColumn("base", _share(0)), "group_shares")
    shares = kept.join(bases, _GROUP).withColumn("p", _share("n")).select(*_TERM, "source", "p", "base")
    shares = write_stage(shares, "term_shares")
    of_lang = in_lang.join(langs.select("lang", "terms", F.col("all").alias("total")), "lang")
    of_lang = of_lang.withColumn("q", _share("n")).select(*_TERM, "q")
    return _pairs(shares, bases).unionByName(_terms(shares, of_lang, names, top_terms))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.desc("value"), F.asc("item")))
    return rows.select(*_GROUP, F.lit(part).alias("part"), "item", "value", place.alias("rank"))


def _terms(shares: DataFrame, of_lang: DataFrame, names: DataFrame, top: int) -> DataFrame:
    above = shares.join(of_lang, _TERM).withColumn("value", F.col("p") - F.col("q")).where("value > 0")
    # ties with the last place stay until their texts are known
    best = F.rank().over(Window.partitionBy(*_GROUP).orderBy(F.desc("value")))
    chosen = write_stage(above.withColumn("_best", best).where(F.col("_best") <= top).drop("_best"), "top_terms")
    return _ranked(chosen.join(names, _TERM).withColumnRenamed("term", "item"), "term").where(F.col("rank") <= top)


def _pairs(shares: DataFrame, bases: DataFrame) -> DataFrame:
    """Distances of all pairs of sources of a language, as the sum of four kinds of parts.

    With the shares P, Q of two sources and their shares p, q for a term that they lack, the
    distance is V*|p-q|, plus |P-q|-|p-q| for the terms of one, plus |Q-p|-|p-q| for those of the
    other, plus |P-Q|-|P-q|-|Q-p|+|p-q| for the terms of both.
    """
    far = F.abs
    one = shares.select(*_TERM, F.col("source").alias("a"), F.col("p").alias("pa"), F.col("base").alias("ba"))
    two = shares.select(*_TERM, F.col("source").alias("b"), F.col("p").alias("pb"), F.col("base").alias("bb"))
    both = (
        one.join(two, _TERM)
        .where("a < b")
        .groupBy("lang", "a", "b")
        .agg(
            F.sum(
                far(F.col("pa") - F.col("pb")) - far(F.col("pa") - F.col("bb"))
                - far(F.col("ba") - F.col("pb")) + far(F.col("ba") - F.col("bb"))
            ).alias("value")
        )
    )
    # The sources of a language meet its shares in salted parts, so a language with most rows is no hot key.
    alike = shares.groupBy("lang", F.col("source").alias("a"), "p", F.col("base").alias("ba")).agg(F.count("*").alias("n"))
    alike = alike.withColumn("_salt", F.pmod(F.xxhash64("a", "p"), F.lit(_SALTS)))
    others = bases.select("lang", F.col("source").alias("b"), F.col("base").alias("bb"))
    salted = others.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    single = (
        alike.join(salted, ["lang", "_salt"])
        .where("a != b")
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.col("n") * (far(F.col("p") - F.col("bb")) - far(F.col("ba") - F.col("bb")))).alias("value"))
    )
    mine = bases.select("lang", F.col("source").alias("a"), F.col("base").alias("ba"), "terms")
    none = mine.join(others, "lang").where("a != b")
    none = none.select("lang", "a", "b", (F.col("terms") * far(F.col("ba") - F.col("bb"))).alias("value"))
    turned = [part.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value") for part in (both, single)]
    rows = reduce(DataFrame.unionByName, [none, both, single, *turned])
    total = rows.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
    return _ranked(total, "pair")
