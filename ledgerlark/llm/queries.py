"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    class_ngrams,
    cross_polytope,
    html_text,
    line_dedup,
    packing,
    periodic_runs,
    pii,
    sentencepiece_offsets,
    simhash_blocks,
    simhash_pivots,
    source_divergence,
    toxicity,
    warc,
)
from ledgerlark.storage import write_stage


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_pivots.near_duplicates(_table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def shared_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.deduplicated(_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, folder, "labels").select("doc_id", "toxic"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % toxicity.FOLDS == 0
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("start").alias("worst_start"),
        F.col("end").alias("worst_end"),
        F.col("worst").alias("worst_score"),
    )


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(_table(spark, folder, "documents").select("doc_id", "text"))

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == number)).cast("long")

    return found.select(
        "doc_id",
        *(count(number).alias(f"n_{kind}") for number, kind in enumerate(pii.KINDS)),
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = cross_polytope.near_duplicates(_table(spark, folder, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash_blocks.compare_edited(_table(spark, folder, "documents"))
    rows = write_stage(rows, "compared")
    names = [f"fp{n}" for n in range(simhash_blocks.WORDS)]
    # every document whose id is divisible by 50 is searched for among all
    asked = F.col("doc_id") % 50 == 0
    near = simhash_blocks.count_near(rows, rows.where(asked)).withColumnRenamed("n_near", "_near")
    return rows.join(near, names, "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash_blocks.written([F.col(n) for n in names]).alias("fingerprint"),
        simhash_blocks.written([F.col(f"edited{n}") for n in range(len(names))]).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(asked, F.col("_near") - 1).alias("n_near"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    )


def language_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return class_ngrams.score(_table(spark, folder, "documents"))


def piece_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = sentencepiece_offsets.encode(
        _table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model")
    )
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.crc32("begins").alias("spans_crc32"),
    )


def source_divergences(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.divergence(_table(spark, folder, "documents"))


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words of a tenth of the documents, which go round in a part of their text from some word on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % (1 + (n - a) // (3 + g % 8)))


def periodic_text(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.detect(_table(spark, folder, "documents"), periodic_tail)
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.n").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.n") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def archived_pages(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(_table(spark, folder, "pages")), keep_payload=False)
    return records.where("record_type != 'warcinfo'").select(
        warc.page_column("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_column("refers_to").alias("refers_to"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": simhash_near_dedup,
    "op2_packing": packed_sequences,
    "op3_embedding_near_dedup": near_vectors,
    "op4_toxicity": toxic_documents,
    "op5_line_dedup": shared_lines,
    "op6_html_extraction": page_text,
    "op7_document_fingerprints": document_fingerprints,
    "op8_class_ngrams": language_model_scores,
    "op9_personal_data": personal_data,
    "op10_sentencepiece": piece_ids,
    "op11_source_divergence": source_divergences,
    "op12_periodic_runs": periodic_text,
    "op13_warc": archived_pages,
}

ORACLE: dict[str, str] = {
    "op5_line_dedup": r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), shared AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT keyed.*, coalesce(doc_id < last_doc, false) AS gone FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_source_divergence": r"""
WITH doc AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), held AS (
    SELECT id, lang, source, unnest(terms) AS term FROM doc
), kept AS (
    SELECT lang, term FROM held GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM held JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (
    SELECT DISTINCT lang, source FROM doc
), size AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), total AS (
    SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), share AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0)::HUGEINT + 5 * s.v) AS p
    FROM grp g JOIN kept k USING (lang) JOIN size s USING (lang)
    LEFT JOIN total t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n)::HUGEINT + 5)) // (any_value(total)::HUGEINT + 5 * any_value(v)) AS q
    FROM counts JOIN (SELECT lang, sum(total) AS total FROM total GROUP BY lang) USING (lang) JOIN size USING (lang)
    GROUP BY lang, term
), pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce((SELECT sum(abs(x.p - y.p)) FROM share x JOIN share y USING (lang, term)
            WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
), term AS (
    SELECT s.lang, s.source, 'term' AS part, s.term AS item, (s.p - w.q)::BIGINT AS value
    FROM share s JOIN whole w USING (lang, term) WHERE s.n > 0 AND s.p > w.q
)
SELECT lang, source, part, item, value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR rank <= 50
""",
    "op13_warc": r"""
WITH page AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), payload AS (
    SELECT *, sha1(html) AS payload_digest,
        CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS last_page
    FROM page
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id < last_page THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < last_page THEN last_page END AS refers_to
FROM payload
""",
}
