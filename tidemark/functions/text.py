"""Text normalisation. Only the space character counts as blank."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL where nothing but blanks is left."""
    return F.nullif(F.trim(c), F.lit(""))


def fold(c: Column) -> Column:
    """Comparison form of a text: text equality ignores case everywhere.

    Accents are kept apart.
    """
    return F.lower(c)


def canonicalize(c: Column, spellings: Iterable[str], default: str | None = None) -> Column:
    """Map any casing of a known value to its canonical spelling.

    Unknown and missing values become ``default``.
    """
    key = F.lower(F.trim(c))
    known = None
    for spelling in spellings:
        match = key == spelling.lower()
        known = F.when(match, spelling) if known is None else known.when(match, spelling)
    return known.otherwise(F.lit(default))
