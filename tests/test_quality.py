import json

import pytest

from cellstar.operators import checks
from cellstar.plans import quality

LONG = "indicator string, year_label string, value double"


def by_name(rows):
    return {r.check_name: r for r in rows.collect()}


def test_a_clean_table_passes_everything(spark):
    rows = spark.createDataFrame([(f"name {i}", "2016/17", float(i)) for i in range(30)], LONG)
    found = quality.validate_domain(rows)
    assert [(r.check, r.passed, r.score) for r in found.collect()] == [
        (name, True, 1.0)
        for name in ["completeness", "validity", "consistency", "uniqueness", "data_types", "name_validity", "year_range"]
    ]
    summary = quality.summarise_domain(found).first()
    assert summary.checks_run == 5 and summary.overall_score == 100.0 and summary.all_passed_domain


def test_failures_are_counted(spark):
    rows = spark.createDataFrame(
        [
            ("beds", "2016/17", 1.0),
            ("beds", "2016/17", 1.0),
            ("", "1999/00", -1.0),
            (None, "2016-17", float("inf")),
            ("nurses", None, None),
        ],
        LONG,
    )
    metrics = by_name(quality.domain_metrics(rows, "t"))
    assert metrics["completeness_indicator"].failure_count == 1
    assert metrics["completeness_indicator"].metric_value == pytest.approx(0.8)
    assert metrics["validity_no_negatives"].failure_count == 1
    assert metrics["validity_no_negatives"].row_count == 4
    assert metrics["validity_value_range"].failure_count == 2
    assert metrics["validity_no_infinites"].failure_count == 1
    assert metrics["consistency_no_duplicates"].failure_count == 1
    assert metrics["uniqueness_key_constraint"].failure_count == 2
    assert json.loads(metrics["uniqueness_key_constraint"].details)["key_columns"] == ["indicator", "year_label"]
    assert metrics["consistency_year_format"].failure_count == 1
    assert metrics["health_indicator_names_valid"].failure_count == 3
    assert metrics["health_year_range_valid"].failure_count == 1
    assert json.loads(metrics["health_year_range_valid"].details)["min_year"] == 1999

    results = {r.check: r for r in quality.validate_domain(rows).collect()}
    assert results["validity"].score == 0.0 and results["data_types"].passed
    assert results["uniqueness"].score == pytest.approx(0.6)


def test_no_value_means_no_value_metrics_and_a_pass(spark):
    rows = spark.createDataFrame([("a", "2016/17", None)], LONG)
    assert not [n for n in by_name(quality.validate_metrics(rows, "t")) if n.startswith("validity_")]
    assert {r.check: r.passed for r in quality.validate(rows).collect()}["validity"]


def test_empty_table(spark):
    rows = spark.createDataFrame([], LONG)
    assert {r.check: r.passed for r in quality.validate(rows).collect()} == dict.fromkeys(
        ["completeness", "validity", "consistency", "uniqueness", "data_types"], True
    )


def test_text_values_fail_the_type_check_only(spark):
    rows = spark.createDataFrame([("a", "2016/17", "x")], "indicator string, year_label string, value string")
    results = {r.check: (r.passed, r.score) for r in quality.validate(rows).collect()}
    assert results["data_types"] == (False, 0.5) and results["validity"] == (True, 1.0)


def test_no_key_column_is_a_pass(spark):
    rows = spark.createDataFrame([(1,), (1,)], "x int")
    assert {r.check: r.passed for r in quality.validate(rows).collect()}["uniqueness"]


def test_mixed_types(spark):
    rows = spark.createDataFrame([("1", "a"), ("2.5", "b"), (None, "c")], "m string, t string")
    found = {r.column_name: (r.n_types, r.passed) for r in checks.mixed_types(rows, ["m", "t"]).collect()}
    assert found == {"m": (2, False), "t": (1, True)}


def test_checks_share_one_pass(spark):
    rows = spark.createDataFrame([("a", "2016/17", 1.0)], LONG)
    row_local = [checks.completeness(rows.columns), checks.validity(rows), checks.period_format(), checks.year_range()]
    plan = checks.metric_rows(rows, "t", row_local)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_rules(spark):
    rows = spark.createDataFrame(
        [(1, 1, 5.0, "A-1"), (2, None, None, "B-2"), (None, 1, -5.0, "bad")],
        "indicator_id int, date_id int, value double, code string",
    )
    extra = [
        ("code", "validity", "fact_indicator_values", "code", "pattern", '{"pattern": "^[A-Z]-[0-9]$", "threshold": 0.5}', True, "info"),
        ("off", "validity", "fact_indicator_values", "value", "range", '{"min": 0}', False, "info"),
        ("other", "validity", "other_table", "value", "range", '{"min": 0}', True, "info"),
    ]
    rules = quality.seed_rules(spark).unionByName(quality.rule_rows(spark, extra))
    found = {r.rule_name: (r.passed, r.row_count, r.failure_count) for r in quality.evaluate_rules(rows, rules, "fact_indicator_values").collect()}
    assert found == {
        "completeness_indicator": (False, 3, 1),
        "completeness_value": (False, 3, 1),
        "validity_value_range": (False, 2, 1),
        "consistency_foreign_keys": (False, 3, 2),
        "code": (True, 3, 1),
    }
    with pytest.raises(ValueError):
        quality.evaluate_rules(rows, rules, "nothing")


def test_structure(spark):
    full = spark.createDataFrame([("2016/17", 1.0), ("2017/18", None)], "year_label string, value double")
    empty = spark.createDataFrame([], "year_label string")
    found = {r.table_name: r for r in quality.structure({"a": (full, ["year_label", "value"]), "b": (empty, ["year_label", "value"])}).collect()}
    assert (found["a"].passed, found["a"].row_count, found["a"].null_rows) == (True, 2, 1)
    assert (found["b"].passed, found["b"].columns_present) == (False, False)
