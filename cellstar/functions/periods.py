"""Period labels such as ``2016/17`` (fiscal, starts in July) and ``2016`` (calendar)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellstar.functions.text import strip

# Fixed value: the label format that quality checks expect.
FISCAL_LABEL = r"^\d{4}/\d{2}$"


def has_digit(text: Column) -> Column:
    return text.rlike(r"\d")


def looks_like_period(text: Column) -> Column:
    """A slash and a digit: the mark of a header cell."""
    return F.contains(text, F.lit("/")) & has_digit(text)


def period_year(label: Column) -> Column:
    """First year of the label, NULL when it cannot be read."""
    head = strip(F.split_part(label, F.lit("/"), F.lit(1)))
    return F.when(head.rlike(r"^[+-]?\d+$"), head.try_cast("int"))


def period_start(label: Column) -> Column:
    """First of July for fiscal labels, first of January otherwise."""
    year = period_year(label)
    month = F.when(F.contains(label, F.lit("/")), F.lit(7)).otherwise(F.lit(1))
    return F.when(year.between(1, 9999), F.make_date(year, month, F.lit(1)))
