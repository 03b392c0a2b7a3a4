from datetime import date

from pyspark.sql import functions as F

from cellstar.operators import warehouse
from cellstar.operators.dense_ids import with_dense_ids


def test_names_that_share_a_key_share_a_row(spark):
    names = spark.createDataFrame(
        [("hosp a",), ("Hosp A",), ("HOSP_A",), (" Hosp B ",), ("",), ("  ",), (None,), ("x" * 300,), ("x" * 290,)],
        "indicator string",
    )
    rows = {r.indicator_key: r.indicator_name for r in warehouse.new_indicators(names).collect()}
    assert rows == {"hosp_a": "HOSP_A", "hosp_b": "Hosp B", "x" * 300: "x" * 300, "x" * 290: "x" * 290}


def test_upsert_adds_only_new_keys_after_the_last_id(spark):
    first = warehouse.new_indicators(spark.createDataFrame([("a",), ("b",)], "indicator string"))
    second = warehouse.new_indicators(
        spark.createDataFrame([("A",), ("c",), ("d",)], "indicator string"), first
    )
    assert sorted(r.indicator_id for r in first.collect()) == [1, 2]
    assert sorted((r.indicator_key, r.indicator_id) for r in second.collect() if r.indicator_id > 2)
    assert sorted(r.indicator_id for r in second.collect()) == [3, 4]
    assert sorted(r.indicator_key for r in second.collect()) == ["c", "d"]


def test_dates(spark):
    labels = spark.createDataFrame(
        [("2016/17",), (" 2016/17 ",), ("2016",), ("x",), ("",), (None,), ("2016/17_1",)], "year_label string"
    )
    rows = {r.period_label: (r.year, r.date_value) for r in warehouse.new_dates(labels).collect()}
    assert rows == {
        "2016/17": (2016, date(2016, 7, 1)),
        "2016": (2016, date(2016, 1, 1)),
        "x": (None, None),
        "2016/17_1": (2016, date(2016, 7, 1)),
    }


def test_dense_ids_are_consecutive_and_repeatable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("k"))
    once = {r.k: r.n for r in with_dense_ids(rows, "k", "n", 10).collect()}
    again = {r.k: r.n for r in with_dense_ids(rows.repartition(13), "k", "n", 10).collect()}
    assert sorted(once.values()) == list(range(11, 5011))
    assert once == again


def test_unknown_keys_stay_as_facts(spark):
    long = spark.createDataFrame(
        [("Beds", "2016/17", 1.0), ("beds", "2017/18", 2.0), ("Nurses", "2016/17", 3.0), (None, "2016/17", 4.0)],
        "indicator string, year_label string, value double",
    )
    indicators = warehouse.new_indicators(long.limit(1))
    dates = warehouse.new_dates(long.limit(1))
    facts = warehouse.with_fact_keys(long, indicators, dates)
    assert sorted((r.value, r.indicator_id, r.date_id) for r in facts.collect()) == [
        (1.0, 1, 1), (2.0, 1, None), (3.0, None, 1), (4.0, None, 1),
    ]
    check = warehouse.referential_integrity(facts).first()
    assert (check.passed, check.failure_count, check.metric_value) == (False, 3, 0.0)
    assert check.details == '{"orphan_records":3}'


def test_locations_are_optional(spark):
    long = spark.createDataFrame(
        [("a", "2016", 1.0, "north"), ("a", "2016", 2.0, "south")],
        "indicator string, year_label string, value double, location string",
    )
    places = spark.createDataFrame([(7, "north")], "location_id bigint, location_name string")
    found = warehouse.with_fact_keys(long, warehouse.new_indicators(long), warehouse.new_dates(long), places)
    assert sorted((r.value, r.location_id) for r in found.collect()) == [(1.0, 7), (2.0, None)]


def test_null_values_pass_the_sign_check(spark):
    facts = spark.createDataFrame([(1.0,), (0.0,), (None,), (-1.0,)], "value double")
    good, bad = warehouse.split_non_negative(facts)
    assert (good.count(), bad.count()) == (3, 1)


def test_completeness_gate(spark):
    long = spark.createDataFrame([("a", "2016", 1.0), (None, "2016", 2.0)], "indicator string, year_label string, value double")
    rows = {r.column_name: r for r in warehouse.completeness_gate(long).collect()}
    assert not rows["indicator"].passed and rows["indicator"].failure_count == 1
    assert rows["value"].passed and rows["value"].metric_value == 1.0


def test_volume_of_an_empty_warehouse_fails(spark):
    empty = spark.createDataFrame([], "x int")
    row = warehouse.load_volume(empty, empty, empty).first()
    assert (row.passed, row.metric_value) == (False, 0.0)
