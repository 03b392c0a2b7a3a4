"""Strict number parsing and exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellstar.functions.text import strip

# Fixed value: what counts as a number once thousands commas are gone. Narrower than
# a Spark cast, which also takes 1d, 1f, inf and NaN.
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def number_text(text: Column) -> Column:
    return strip(F.replace(text, F.lit(","), F.lit("")))


def is_numeric_text(text: Column) -> Column:
    return number_text(text).rlike(NUMBER_PATTERN)


def parse_number(text: Column) -> Column:
    """Double value of a cell, NULL when it is not a number."""
    return F.when(is_numeric_text(text), number_text(text).try_cast("double"))


def round2(value: Column) -> Column:
    """Two decimals, half up on the decimal value rather than on its binary image."""
    return F.round(value.cast("decimal(38,8)"), 2).cast("double")


def exact_mean(total: Column, count: Column) -> Column:
    """Mean from mergeable parts; decimal totals divide exactly, empty input gives NULL."""
    return F.try_divide(total, count)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` of two counts, rounded exactly."""
    ratio = F.try_divide(part.cast("decimal(20,0)") * 100, whole)
    return F.round(ratio, digits).cast("double")
