from datetime import date, datetime

import pytest

from cellstar.plans import book, catalog, lookup, monitoring, pipeline, profile
from cellstar.sources.store import Store
from tests.xlsx import write_workbook

FACT = "fact_id bigint, indicator_id bigint, date_id bigint, value decimal(18,2), units string, notes string"


@pytest.fixture(scope="module")
def star(spark):
    from decimal import Decimal as D

    indicators = spark.createDataFrame(
        [(1, "a", "Alpha", "x"), (2, "b", "Beta", "x"), (3, "c", "Gamma", None)],
        "indicator_id bigint, indicator_key string, indicator_name string, category string",
    )
    dates = spark.createDataFrame(
        [(1, 2016, "2016/17", date(2016, 7, 1)), (2, 2017, "2017/18", date(2017, 7, 1)), (3, None, "odd", None)],
        "date_id bigint, year int, period_label string, date_value date",
    )
    rows = [
        (1, 1, 1, D("10")), (2, 1, 1, D("-4")), (3, 1, 2, D("0")), (4, 1, 2, None), (5, 2, 1, D("0")),
        (6, 2, 2, D("5")), (7, 2, 3, D("7")), (8, 9, 1, D("100")), (9, 1, 9, D("100")),
    ]
    facts = spark.createDataFrame([(*r, None, None) for r in rows], FACT)
    return facts, indicators, dates


def rows(frame, *columns):
    return [tuple(r[c] for c in columns) for r in frame.collect()]


def test_growth_needs_a_positive_previous_value(star):
    assert rows(book.yoy_growth(*star), "indicator_name", "year", "total_value", "prev_year_value", "yoy_growth_percent") == [
        ("Alpha", 2016, 6.0, None, None),
        ("Alpha", 2017, 0.0, 6.0, -100.0),
        ("Beta", 2016, 0.0, None, None),
        ("Beta", 2017, 5.0, 0.0, None),
        ("Beta", None, 7.0, 5.0, 40.0),
    ]


def test_orphans_are_counted_per_dimension(star):
    assert rows(book.orphan_facts(*star), "count") == [(1,), (1,)]


def test_buckets(star):
    plain = dict(rows(book.value_distribution(star[0]), "value_range", "count"))
    assert plain == {"Zero": 2, "1-10": 3, "51-100": 2, "10000+": 2}
    strict = dict(rows(book.value_distribution(star[0], strict=True), "value_range", "count"))
    assert strict == {"Zero": 2, "1-10": 3, "51-100": 2, "Negative": 1, "Null": 1}
    edges = dict(rows(book.value_distribution(star[0], edges=[0, 50]), "value_range", "count"))
    assert edges == {"Zero": 2, "1-50": 3, "50+": 4}


def test_single_values_have_no_spread(spark, star):
    facts = star[0].where("fact_id = 6")
    row = book.lowest_cv(facts, star[1], at_least=1).first()
    assert (row.measurements, row.std_dev, row.cv_percent) == (1, None, None)
    assert book.zscore_outliers(facts).isEmpty()


def test_duplicates_by_value(spark, star):
    twice = star[0].unionByName(star[0].where("fact_id = 4"))
    assert rows(book.duplicate_records(twice), "indicator_id", "date_id", "value", "duplicate_count") == [(1, 2, None, 2)]


def test_distinct_counts_ignore_nulls(star):
    exact = book.distinct_counts(star[0]).first()
    assert tuple(exact) == (3, 4, 6)
    assert tuple(book.distinct_counts(star[0], approximate=True).first()) == (3, 4, 6)


def test_quarters_skip_periods_without_a_date(star):
    assert rows(book.quarter_pattern(star[0], star[2]), "period_label", "quarter", "measurements") == [
        ("2016/17", "Q3", 4), ("2017/18", "Q3", 3),
    ]


def test_indicators_without_facts_are_listed(star):
    found = {r.indicator_name: r for r in lookup.indicator_metadata(*star).collect()}
    assert (found["Gamma"].data_points, found["Gamma"].value_range, found["Gamma"].first_period) == (0, None, None)
    assert found["Alpha"].value_range == [-4.0, 100.0] and found["Alpha"].data_points == 5
    assert tuple(lookup.metadata_totals(star[0], star[1]).first()) == (3, 8)


def test_search_arguments(star):
    page = lookup.indicators(*star, indicator="alp", sort_by="value", sort_order="desc", limit=2, offset=1)
    assert rows(page, "value") == [(10.0,), (0.0,)]
    assert rows(lookup.indicators(*star, period="odd"), "indicator_name") == [("Beta",)]
    assert lookup.indicators(*star, year=0).isEmpty()
    assert lookup.indicators(*star, indicator="%").isEmpty()
    for wrong in ({"limit": 0}, {"limit": 1001}, {"offset": -1}, {"sort_by": "units"}, {"sort_order": "up"}):
        with pytest.raises(ValueError):
            lookup.indicators(*star, **wrong)


def test_series(star):
    found = rows(lookup.timeseries(*star, name="ALPHA"), "period", "value", "prev_value", "change_pct")
    assert found == [
        ("2016/17", 10.0, None, None),
        ("2016/17", -4.0, 10.0, -140.0),
        ("2017/18", 0.0, -4.0, -100.0),
        ("2017/18", None, 0.0, None),
    ]
    stats = {r.indicator_name: (r.data_points, r.average, r.trend) for r in lookup.series_statistics(*star).collect()}
    assert stats == {"Alpha": (3, 2.0, "decreasing"), "Beta": (3, 4.0, "increasing")}
    one = lookup.series_statistics(star[0].where("fact_id = 1"), star[1], star[2]).first()
    assert one.trend == "insufficient_data"


def test_rankings(star):
    latest = lookup.rankings(*star)
    assert rows(latest, "period_label", "rank", "indicator_name") == [("odd", 1, "Beta")]
    named = lookup.rankings(*star, period="2016/17", metric="avg_value")
    assert rows(named, "rank", "indicator_name", "value", "change_from_previous") == [
        (1, "Alpha", 3.0, None), (2, "Beta", 0.0, -100.0),
    ]
    with pytest.raises(ValueError):
        lookup.rankings(*star, limit=51)
    with pytest.raises(ValueError):
        lookup.rankings(*star, metric="median")


def test_profile(star):
    assert profile.overall(*star).first().total_records == 7
    described = profile.describe(star[0]).first()
    assert (described["count"], described.p50, described.max) == (8, 6.0, 100.0)
    assert profile.quality(star[0].select("indicator_id", "value")).first().duplicate_records == 0


def test_empty_tables(star):
    facts = star[0].limit(0)
    assert lookup.dataset_stats(facts, star[1], star[2]).first().total_records == 0
    assert lookup.quality_snapshot(facts).first().data_completeness == "PASSED"
    assert book.top_indicators(facts, star[1]).isEmpty()
    assert profile.describe(facts).first()["count"] == 0


def test_look_backs_take_a_moment(spark):
    metrics = spark.createDataFrame(
        [(1, "r", "c", "validity", True, datetime(2024, 1, 1)), (2, "r", "c", "validity", False, datetime(2024, 1, 9))],
        "metric_id int, run_id string, check_name string, check_category string, passed boolean, checked_at timestamp",
    )
    row = monitoring.quality_by_category(metrics, datetime(2024, 1, 10), 7).first()
    assert (row.total_checks, row.passed_checks, row.pass_rate) == (1, 0, 0.0)
    assert monitoring.quality_by_category(metrics, datetime(2024, 1, 10), 30).first().pass_rate == 50.0
    with pytest.raises(ValueError):
        monitoring.quality_by_category(metrics, datetime(2024, 1, 10), 91)


def test_sql_over_a_loaded_store(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_workbook(source / "a.xlsx", {"s": [["Indicator", "2016/17", "2017/18"], ["Beds", "1,200", 7]]})
    store = Store(spark, str(tmp_path / "out"))
    pipeline.run(store, str(source))
    catalog.register(store)
    top = spark.sql("""
        SELECT i.indicator_name, round(sum(f.value), 2) AS total_value FROM fact_indicator_values f
        JOIN dim_indicator i ON f.indicator_id = i.indicator_id GROUP BY i.indicator_name, i.indicator_id
        ORDER BY total_value DESC LIMIT 10""")
    assert [(r.indicator_name, float(r.total_value)) for r in top.collect()] == [("Beds", 1207.0)]
    run = spark.sql("SELECT run_id FROM pipeline_runs WHERE pipeline_stage = 'load'").first().run_id
    assert spark.sql(f"SELECT get_quality_score('{run}') AS s").first().s == 100.0
    assert spark.sql("SELECT get_quality_score('none') AS s").first().s == 0.0
    lineage = spark.sql("SELECT * FROM get_field_lineage('fact_indicator_values', 'value')").collect()
    assert [r.source_column for r in lineage] == ["value"]
    assert spark.sql("SELECT * FROM v_pipeline_health").first().total_runs == 3
    assert spark.sql("SELECT * FROM v_failed_quality_checks").count() >= 0
    assert spark.sql("SELECT periods_covered FROM indicator_summary").first()[0] == 2
