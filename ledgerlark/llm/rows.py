"""Rows set aside whole, so that helper columns cannot meet the columns of the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def folded(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): the row as one column, and copies of what operators read."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def unfolded(rows: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of docs from `row`, with another text if given."""
    return rows.select(
        *[(text if c == "text" and text is not None else F.col("row")[c]).alias(c) for c in docs.columns]
    )
