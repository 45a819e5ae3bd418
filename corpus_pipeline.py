"""Pipeline over the documents table: toxicity, line dedup, near dedup, personal data, packing.

Every stage is written as Parquet to the shared folder and read again by the
next one. All but the last return the columns of documents, whatever other columns there
are and whatever their names.

Nulls, empty texts and repeated rows: a null text counts as empty and, from the line stage on, is the empty
text; empty texts are near copies of each other, of which the one with the least id stays; repeated rows are
copies. Rows without an id are scored and packed like others, and stay only if their group has no id. Ties go to
the least id. Empty tables give an empty result; without labels of both kinds no document is rejected unless
all labels are toxic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import line_dedup, packing, pii, simhash_pivots, toxicity
from ledgerlark.llm.queries import tokenizer_file
from ledgerlark.storage import write_stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return toxicity.accepted(docs, model)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more of them share; one holder keeps each."""
    return _with_length(docs, line_dedup.remove_shared_lines(docs))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_pivots.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _with_length(docs, pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


def _with_length(docs: DataFrame, changed: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: SQL can express neither the trained scores nor the fingerprints nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return docs
