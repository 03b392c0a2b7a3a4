from datetime import date

import pytest
from pyspark.sql import functions as F

from cellstar.functions import (
    blank_to_null,
    indicator_key,
    parse_number,
    percent,
    period_start,
    period_year,
    round2,
    safe_name,
)


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in rows.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def test_numbers_are_parsed_strictly(spark):
    texts = ["1,200", " 5 ", "1e3", ".5", "5.", "-3", "+4", "1d", "1f", "1_000", "inf", "NaN", "0x10", "x", "", "-", None]
    assert apply(spark, parse_number, texts) == [
        1200.0, 5.0, 1000.0, 0.5, 5.0, -3.0, 4.0, None, None, None, None, None, None, None, None, None, None,
    ]


def test_periods(spark):
    labels = ["2016/17", "1999/00", "2016", " 2018/19 ", "2016-17", "", None, "n/a", "2016/17_1", "0/1", "99999999999/1"]
    assert apply(spark, period_year, labels) == [2016, 1999, 2016, 2018, None, None, None, None, 2016, 0, None]
    assert apply(spark, period_start, labels) == [
        date(2016, 7, 1), date(1999, 7, 1), date(2016, 1, 1), date(2018, 7, 1), None, None, None, None,
        date(2016, 7, 1), None, None,
    ]


def test_names(spark):
    assert apply(spark, indicator_key, ["Hosp A", "HOSP_A", "x" * 300, None]) == ["hosp_a", "hosp_a", "x" * 300, None]
    assert apply(spark, blank_to_null, [" a\t", "  \n", "", None]) == ["a", None, None, None]
    names = ["Data 2016/17 (rev.)", " é-1 ", "a\nb", "日本"]
    assert apply(spark, safe_name, names) == ["Data_2016_17__rev__", "é-1", "a_b", "日本"]


@pytest.mark.parametrize("value, expected", [(2.675, 2.68), (-2.675, -2.68), (1.005, 1.01), (0.125, 0.13)])
def test_rounding_is_decimal(spark, value, expected):
    assert apply(spark, round2, [value], "double") == [expected]


def test_percent_of_nothing_is_null(spark):
    row = spark.range(1).select(percent(F.lit(1), F.lit(0)).alias("p"), percent(F.lit(1), F.lit(3)).alias("q")).first()
    assert row.p is None and row.q == 33.33
