"""Removal of lines that many documents share; built-in functions only.

Hashes of line keys are range-partitioned with a secondary sort by document and
position. The sorted rows are streamed: the first occurrence of a key in a
document counts that document, and per key the number of documents and the
last one that holds it are merged per task before the only shuffle on the bare
key. A range covers (key, document), so a key that a third of all documents
hold is spread over many tasks. A key that a thousandth of all lines has is broadcast
with its verdict, so its lines never meet in one task. What comes back per document is
a compressed bitmap of the lines that it keeps, never text.

A line's key is the line without ASCII white space at both ends, A-Z in lower
case. A key of at least `least_chars` code points found in at least
`least_docs` documents stays in the document with the largest id only.

Nulls and ties: a null or empty text is one empty line. Documents with equal
ids count as one. Documents with a null id do not count as holders, and lose
every line whose key others share. Rows that are repeated are treated alike. Other
columns stay, whatever their names; an empty table has an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.hot_keys import join_one
from ledgerlark.llm.rows import folded, unfolded
from ledgerlark.storage import write_stage

LEAST_CHARS = 20
LEAST_DOCS = 3
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(_SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shared_keys(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(h1, h2, last_doc, holders): keys that at least `least_docs` documents hold, of rows (h1, h2, doc_id, pos)."""
    ranged = lines.select("h1", "h2", "doc_id", "pos").repartitionByRange("h1", "h2", "doc_id")
    place = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")
    first = ranged.sortWithinPartitions("h1", "h2", "doc_id", "pos").withColumn("_place", F.row_number().over(place))
    counted = first.where("_place = 1").groupBy("h1", "h2")
    return counted.agg(F.max("doc_id").alias("last_doc"), F.count("doc_id").alias("holders")).where(
        F.col("holders") >= least_docs
    )


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, row_hash, n_dropped, keeps) per document of docs (doc_id, text) that loses a line.

    `keeps` is a compressed bitmap: (word, mask) pairs by word, where bit i of the mask is set if line
    64 word + i stays. Words without a pair keep all their lines.
    """
    exploded = docs.select(
        "doc_id", _row_hash(F.col("text")).alias("row_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    ).withColumn("key", line_key(F.col("line")))
    lines = write_stage(
        exploded.where(F.char_length("key") >= least_chars).select(
            "doc_id", "row_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")
        ),
        "lines",
    )
    shared = write_stage(shared_keys(lines, least_docs), "shared_keys")
    gone = join_one(lines, shared, ["h1", "h2"], "holders").where("doc_id is null or doc_id < last_doc")
    words = gone.groupBy("doc_id", "row_hash", F.shiftright("pos", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, pos % 64))").alias("dropped")
    )
    pair = F.struct("word", F.bitwise_not("dropped").alias("mask"))
    return words.groupBy("doc_id", "row_hash").agg(
        F.sum(F.bit_count("dropped")).alias("n_dropped"), F.sort_array(F.collect_list(pair)).alias("keeps")
    )


#: All words of a bitmap up to its last pair, so that a word is found by its place.
_WORDS = (
    "flatten(transform(keeps, (x, i) -> concat(array_repeat(-1L, x.word - coalesce(get(keeps, i - 1).word, -1) - 1),"
    " array(x.mask))))"
)
_STAYING = (
    "array_join(filter(lines, (x, i) -> (coalesce(get(words, shiftright(i, 6)), -1L) & shiftleft(1L, i % 64)) != 0), '\n')"
)


def deduplicated(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(row, kept, n_lines, n_dropped) per row of docs: the row as it was, and the text of the lines that stay."""
    bitmaps = keep_bitmaps(docs.select("doc_id", "text"), least_chars, least_docs).withColumnRenamed("doc_id", "id")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (_row_hash(F.col("text")) == F.col("row_hash"))
    rows = folded(docs).join(bitmaps, same, "left")
    rows = rows.withColumns({"lines": _lines(F.col("text")), "words": F.expr(_WORDS)})
    text = F.when(F.col("words").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.expr(_STAYING))
    return rows.select(
        "row",
        text.alias("kept"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def remove_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """docs with the text of the lines that stay, all other columns as they were."""
    return unfolded(deduplicated(docs, least_chars, least_docs), docs, F.col("kept"))
