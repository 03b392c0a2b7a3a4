"""Column functions shared by all plans; every one stays inside the JVM."""

from cellstar.functions.numbers import exact_mean, is_numeric_text, parse_number, percent, round2
from cellstar.functions.periods import looks_like_period, period_start, period_year
from cellstar.functions.text import blank_to_null, indicator_key, safe_name, strip

__all__ = [
    "blank_to_null",
    "exact_mean",
    "indicator_key",
    "is_numeric_text",
    "looks_like_period",
    "parse_number",
    "percent",
    "period_start",
    "period_year",
    "round2",
    "safe_name",
    "strip",
]
