"""Text expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    """Text without surrounding white space; null stays null."""
    return F.btrim(text, F.lit(_WHITESPACE))


def tidy(text: Column) -> Column:
    """Stripped text, empty where missing."""
    return strip(F.coalesce(text, F.lit("")))


def contains_any(text: Column, terms: list[str]) -> Column:
    """True where `text` holds at least one of the literal `terms`."""
    return reduce(or_, [text.contains(term) for term in terms])


def has_keyword(text: Column, keywords: list[str]) -> Column:
    """True where the lower-cased text holds at least one keyword."""
    return F.lower(text).rlike("|".join(keywords))


def starts_with(text: Column, prefix: str) -> Column:
    """Prefix test that is false, not null, for missing text."""
    return F.coalesce(text.startswith(prefix), F.lit(False))


def number_or_zero(value: Column) -> Column:
    """Number, or zero where the value is missing or not a number."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))
