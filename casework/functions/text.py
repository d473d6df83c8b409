"""Text helpers. In the source systems an absent text and '' are the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def joined_text(*parts: Column | str) -> Column:
    """Concatenate; a null part counts as empty text, an empty result is null.

    Text arguments are literals; pass ``F.col`` for columns.
    """
    texts = [
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
        for p in parts
    ]
    return _blank_to_null(F.concat(*texts))


def text_before_last_hyphen(c: Column) -> Column:
    """'12-3-4' -> '12-3'; null when there is no hyphen or nothing before it."""
    return _blank_to_null(F.regexp_extract(c, "^(.*)-[^-]*$", 1))


def text_after_last_hyphen(c: Column) -> Column:
    """'12-3-4' -> '4'; the whole text when there is no hyphen; null when empty."""
    return F.regexp_substr(c, F.lit("[^-]+$"))


def number_of(c: Column, lenient: bool = False) -> Column:
    """Text to whole number. Junk raises, or gives null when ``lenient``."""
    trimmed = _blank_to_null(F.trim(c))
    return trimmed.try_cast("long") if lenient else trimmed.cast("long")
