"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space removed at both ends of a cell.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def indicator_key(name: Column) -> Column:
    """Lower case, spaces to underscores; the whole name, so that names that differ late stay apart."""
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def safe_name(name: Column) -> Column:
    """Name usable as a file stem: letters, digits, ``_`` and ``-`` only."""
    cleaned = F.regexp_replace(name, r"[^\p{L}\p{N} _-]", "_")
    return F.replace(F.trim(cleaned), F.lit(" "), F.lit("_"))
