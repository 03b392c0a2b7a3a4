"""One callable per contract key: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.functions import parse_number, safe_name
from cellstar.operators import checks, sheets, warehouse
from cellstar.plans import book, lookup, monitoring, profile, quality
from cellstar.sources import files
from contract.inputs import AS_OF, Inputs

Query = Callable[[SparkSession, str], DataFrame]
SEARCH = {"indicator": "SUPPLIER#", "year": 1998, "sort_by": "value", "sort_order": "desc", "limit": 50, "offset": 10}
SERIES = "supplier#000000003"
# Two more rules beside the seeds, one by pattern and one switched off.
EXTRA_RULES = [
    ("format_name", "validity", "fact_indicator_values", "indicator", "pattern",
     '{"pattern": "^Customer#[0-9]{9}$"}', True, "warning"),
    ("unused_rule", "validity", "fact_indicator_values", "value", "range",
     '{"min": 0, "max": 1}', False, "info"),
    ("non_negative", "validity", "fact_indicator_values", None, "custom_sql",
     '{"sql": "value >= 0", "threshold": 0.9}', True, "info"),
]


def _metrics(rows: DataFrame, *found: checks.Check) -> DataFrame:
    return _plain(checks.metric_rows(rows, "data", list(found)))


def _plain(metrics: DataFrame) -> DataFrame:
    """Metric rows without the JSON text, whose number format is the engine's own."""
    return metrics.drop("details")


# -- sheets --------------------------------------------------------------------


def sanitize_names(i: Inputs) -> DataFrame:
    names = i.names.union(i.table("pages").select("url")).where(F.col("indicator").isNotNull())
    return names.select(safe_name(F.col("indicator")).alias("safe_name"))


def header_detect(i: Inputs) -> DataFrame:
    found = sheets.header_rows(i.grid)
    return found.select("source_file", "sheet", "header_row", F.size("header").alias("n_cells"))


def _names(i: Inputs) -> tuple[DataFrame, DataFrame]:
    grid = i.grid
    profile_ = sheets.column_profile(grid)
    return sheets.header_names(sheets.header_rows(grid), profile_), profile_


def header_names(i: Inputs) -> DataFrame:
    return _names(i)[0]


def drop_empty_cols(i: Inputs) -> DataFrame:
    return sheets.filled_columns(*_names(i)).select("source_file", "sheet", "col_idx", "name")


def drop_empty_rows(i: Inputs) -> DataFrame:
    return sheets.filled_rows(i.grid).select("source_file", "sheet", "row_idx")


def period_columns(i: Inputs) -> DataFrame:
    return sheets.period_columns(sheets.layout_of(i.grid))


def id_column(i: Inputs) -> DataFrame:
    return sheets.layout_of(i.grid).select("source_file", "sheet", "id_col", "id_name")


def _unpivoted(i: Inputs) -> DataFrame:
    grid = i.grid
    return sheets.unpivot(grid, sheets.layout_of(grid))


def unpivot_years(i: Inputs) -> DataFrame:
    return _unpivoted(i).select(
        "source_file", "sheet", "row_idx", "indicator", "year_label", "period_label", "text"
    )


def drop_null_values(i: Inputs) -> DataFrame:
    kept = sheets.drop_empty_values(_unpivoted(i))
    return kept.select("source_file", "sheet", "row_idx", "indicator", "year_label", "text")


def clean_numeric(i: Inputs) -> DataFrame:
    return i.numbers.select("text", parse_number(F.col("text")).alias("value"))


def sheets_without_data(i: Inputs) -> DataFrame:
    return sheets.sheets_without_data(i.grid, sheets.clean(_unpivoted(i)))


def row_accounting(i: Inputs) -> DataFrame:
    return sheets.accounting(_unpivoted(i))


# -- warehouse -----------------------------------------------------------------


def fact_load(i: Inputs) -> DataFrame:
    """Long rows against a dimension that lacks some of their indicators."""
    keyed = warehouse.with_fact_keys(i.long, i.indicators_in_credit, i.dates)
    return keyed.select("indicator_id", "date_id", "location_id", "value")


def _loaded(i: Inputs) -> DataFrame:
    return warehouse.with_fact_keys(i.long, i.indicators_in_credit, i.dates)


def load_completeness(i: Inputs) -> DataFrame:
    long = i.nullable.select(
        "indicator", F.when(F.col("lang") != "", F.col("lang")).alias("year_label"), "value"
    )
    return _plain(warehouse.completeness_gate(long))


def load_ref_integrity(i: Inputs) -> DataFrame:
    return _plain(warehouse.referential_integrity(_loaded(i)))


def load_volume(i: Inputs) -> DataFrame:
    """The check's row; the three counts come out of its details."""
    row = warehouse.load_volume(i.facts, i.indicators, i.dates)
    counts = F.from_json("details", "fact_records BIGINT, indicators BIGINT, time_periods BIGINT")
    return row.withColumn("d", counts).select("check_name", "passed", "metric_value", "d.*")


def check_positive_split(i: Inputs) -> DataFrame:
    good, bad = warehouse.split_non_negative(i.signed)
    kept = ["indicator_id", F.col("value").cast("double").alias("value")]
    return good.select(*kept, F.lit(True).alias("accepted")).unionByName(
        bad.select(*kept, F.lit(False).alias("accepted"))
    )


def dim_location_lookup(i: Inputs) -> DataFrame:
    facts = i.table("supplier").select(
        F.col("s_suppkey").alias("fact_id"), F.col("s_nationkey").alias("location_id"), F.col("s_acctbal").alias("value")
    )
    return warehouse.with_location(facts, i.locations)


# -- quality -------------------------------------------------------------------


def dq_no_negatives(i: Inputs) -> DataFrame:
    return _metrics(i.signed, checks.no_negatives())


def dq_value_range(i: Inputs) -> DataFrame:
    return _metrics(i.signed, checks.value_range())


def dq_duplicate_rows(i: Inputs) -> DataFrame:
    rows = i.table("documents").select("text", "lang", "n_chars").unionByName(
        i.table("conversations").select("text", F.col("role").alias("lang"), F.col("turn").alias("n_chars"))
    )
    return _metrics(rows, checks.duplicate_rows(rows))


def dq_key_uniqueness(i: Inputs) -> DataFrame:
    rows = i.table("lineitem")
    return _metrics(rows, checks.key_uniqueness(rows, ["l_orderkey", "l_linenumber"]))


def dq_summary(i: Inputs) -> DataFrame:
    results = i.metrics.select(
        "table_name", "passed", F.least(F.col("threshold_value") / F.greatest("metric_value", "threshold_value"), F.lit(1.0)).alias("score")
    )
    summary = quality.summarise(results, "table_name")
    return summary.withColumn("overall_score", F.round("overall_score", 6))


def dq_rules(i: Inputs) -> DataFrame:
    rules = quality.seed_rules(i.spark).unionByName(quality.rule_rows(i.spark, EXTRA_RULES))
    rows = i.signed.withColumn("date_id", F.col("indicator_id"))
    return quality.evaluate_rules(rows, rules, "fact_indicator_values")


def dq_structure(i: Inputs) -> DataFrame:
    return quality.structure(
        {
            "clean_sheet": (sheets.clean(_unpivoted(i)), ["year_label", "value"]),
            "dim_indicator": (i.indicators, ["indicator_id", "indicator_name"]),
            "dim_date": (i.dates, ["date_id", "period_label"]),
            "fact_indicator_values": (i.facts, ["fact_id", "value"]),
        }
    )


# -- profile -------------------------------------------------------------------


def eda_describe(i: Inputs) -> DataFrame:
    described = profile.describe(i.measures)
    return described.select("count", *[F.round(c, 6).alias(c) for c in described.columns if c != "count"])


def _rounded(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(column, F.round(column, 4))


_ON_INPUTS: dict[str, Callable[[Inputs], DataFrame]] = {
    "sanitize_names": sanitize_names,
    "star_extract": lambda i: lookup.star_extract(i.facts, i.indicators, i.dates),
    "header_detect": header_detect,
    "header_names": header_names,
    "drop_empty_cols": drop_empty_cols,
    "drop_empty_rows": drop_empty_rows,
    "period_columns": period_columns,
    "id_column": id_column,
    "unpivot_years": unpivot_years,
    "drop_null_values": drop_null_values,
    "clean_numeric": clean_numeric,
    "sheets_without_data": sheets_without_data,
    "row_accounting": row_accounting,
    "dim_indicator_build": lambda i: warehouse.new_indicators(i.names),
    "dim_indicator_upsert": lambda i: warehouse.new_indicators(i.names, i.known_indicators),
    "dim_date_build": lambda i: warehouse.new_dates(i.labels),
    "fact_load": fact_load,
    "load_completeness": load_completeness,
    "load_ref_integrity": load_ref_integrity,
    "load_volume": load_volume,
    "check_positive_split": check_positive_split,
    "dim_location_lookup": dim_location_lookup,
    "table_volumes": lambda i: book.table_volumes(
        {"dim_indicator": i.indicators, "dim_date": i.dates, "fact_indicator_values": i.facts}
    ),
    "indicator_sample": lambda i: book.indicator_sample(i.indicators),
    "period_listing": lambda i: book.period_listing(i.dates),
    "completeness_profile": lambda i: book.completeness_profile(i.signed),
    "duplicate_records": lambda i: book.duplicate_records(i.facts, ["l_orderkey", "l_linenumber"]),
    "duplicate_facts": lambda i: book.duplicate_records(i.facts).withColumn("value", F.col("value").cast("double")),
    "orphan_facts": lambda i: book.orphan_facts(i.facts, i.indicators_in_credit, i.dates),
    "top_indicators": lambda i: book.top_indicators(i.facts, i.indicators),
    "highest_average": lambda i: book.highest_average(i.facts, i.indicators),
    "period_trend": lambda i: book.period_trend(i.facts, i.dates),
    "yoy_growth": lambda i: book.yoy_growth(i.facts, i.indicators, i.dates),
    "value_distribution": lambda i: book.value_distribution(i.facts),
    "zscore_outliers": lambda i: book.zscore_outliers(i.measures),
    "named_outliers": lambda i: book.named_outliers(i.facts, i.indicators, i.dates, sigmas=2.0),
    "lowest_cv": lambda i: book.lowest_cv(i.facts, i.indicators),
    "highest_cv": lambda i: book.highest_cv(i.facts, i.indicators),
    "quarter_pattern": lambda i: book.quarter_pattern(i.facts, i.dates),
    "summary_report": lambda i: book.summary_report(i.facts, i.indicators, i.dates),
    "average_ranking": lambda i: book.average_ranking(i.facts, i.indicators),
    "random_sample": lambda i: book.random_sample(i.facts.withColumn("value", F.col("value").cast("double")), seed=7),
    "distinct_counts": lambda i: book.distinct_counts(i.facts),
    "latest_period": lambda i: book.latest_period(i.facts, i.indicators, i.dates),
    "indicator_summary": lambda i: book.indicator_summary(i.facts, i.indicators, i.dates),
    "monthly_summary": lambda i: book.monthly_summary(i.facts, i.indicators, i.dates),
    "stored_indicator_summary": lambda i: book.indicator_summary_of(i.fact_sums, i.indicators, i.dates),
    "stored_monthly_summary": lambda i: book.monthly_summary_of(i.fact_sums, i.indicators, i.dates),
    "indicator_search": lambda i: lookup.indicators(i.facts, i.indicators, i.dates, **SEARCH),
    "metadata_totals": lambda i: lookup.metadata_totals(i.facts, i.indicators_with_planned),
    "indicator_metadata": lambda i: lookup.indicator_metadata(i.facts, i.indicators_with_planned, i.dates),
    "timeseries": lambda i: lookup.timeseries(i.facts, i.indicators, i.dates, SERIES),
    "series_statistics": lambda i: lookup.series_statistics(i.facts, i.indicators, i.dates),
    "rank_total": lambda i: lookup.rankings(i.facts, i.indicators, i.dates),
    "rank_average": lambda i: lookup.rankings(
        i.facts, i.indicators, i.dates, period="1998/99", limit=50, metric="avg_value"
    ),
    "dataset_stats": lambda i: lookup.dataset_stats(i.facts, i.indicators, i.dates),
    "quality_snapshot": lambda i: lookup.quality_snapshot(i.signed),
    "pipeline_health": lambda i: _rounded(monitoring.pipeline_health(i.runs, AS_OF), "avg_duration_seconds"),
    "recent_runs": lambda i: monitoring.recent_runs(i.runs),
    "quality_by_category": lambda i: monitoring.quality_by_category(i.metrics, AS_OF),
    "recent_failures": lambda i: monitoring.recent_failures(i.metrics, AS_OF),
    "lineage_lookup": lambda i: monitoring.lineage_lookup(i.lineage, "table_1", "col_2"),
    "source_file_listing": lambda i: monitoring.source_file_listing(i.files_registry),
    "dashboard_bundle": lambda i: monitoring.dashboard_rows(
        monitoring.dashboard_bundle(i.runs, i.metrics, i.files_registry, AS_OF)
    ),
    "dq_validate_all": lambda i: quality.validate(i.nullable),
    "dq_completeness": lambda i: _metrics(i.nullable, checks.completeness(i.nullable.columns)),
    "dq_no_negatives": dq_no_negatives,
    "dq_value_range": dq_value_range,
    "dq_no_infinites": lambda i: _metrics(i.unbounded_measures, checks.no_infinites()),
    "dq_duplicate_rows": dq_duplicate_rows,
    "dq_period_format": lambda i: _metrics(i.labels, checks.period_format()),
    "dq_key_uniqueness": dq_key_uniqueness,
    "dq_numeric_type": lambda i: _metrics(i.numbers, checks.numeric_text("text")),
    "dq_mixed_types": lambda i: checks.mixed_types(i.numbers, ["text", "shipped", "quantity"]),
    "dq_summary": dq_summary,
    "dq_domain": lambda i: quality.validate_domain(i.long),
    "dq_name_validity": lambda i: _metrics(i.names, checks.name_validity()),
    "dq_year_range": lambda i: _metrics(i.labels, checks.year_range()),
    "dq_raw_completeness": lambda i: checks.raw_completeness(i.grid),
    "dq_rules": dq_rules,
    "dq_structure": dq_structure,
    "run_latest_state": lambda i: monitoring.run_latest_state(i.run_events),
    "file_change_detect": lambda i: files.detect_changes(i.files_now, i.files_registry),
    "content_hash": lambda i: files.content_hashes(i.table("pages"), "html").select("page_id", "file_hash"),
    "run_quality_score": lambda i: monitoring.run_quality_score(i.metrics),
    "run_summary": lambda i: monitoring.run_summary(i.runs, i.metrics),
    "v_recent_runs": lambda i: monitoring.v_recent_runs(i.runs),
    "v_pipeline_health": lambda i: _rounded(monitoring.v_pipeline_health(i.runs, AS_OF), "avg_duration_seconds"),
    "v_quality_trend": lambda i: monitoring.v_quality_trend(i.metrics, AS_OF),
    "v_failed_checks": lambda i: monitoring.v_failed_checks(i.metrics, i.runs),
    "field_lineage": lambda i: monitoring.field_lineage(i.lineage, "table_1", "col_2"),
    "monitor_runs": lambda i: monitoring.monitor_runs(i.runs, 20),
    "health_bands": lambda i: monitoring.health_bands(i.runs, AS_OF),
    "quality_bands": lambda i: monitoring.quality_bands(i.metrics, AS_OF),
    "table_lineage": lambda i: monitoring.table_lineage(i.lineage, "table_1"),
    "failed_runs": lambda i: monitoring.failed_runs(i.runs),
    "score_by_run": lambda i: monitoring.score_by_run(i.runs, i.metrics, AS_OF),
    "slow_runs": lambda i: monitoring.slow_runs(i.runs),
    "score_bands": lambda i: monitoring.score_bands(i.metrics),
    "eda_overall": lambda i: profile.overall(i.facts, i.indicators, i.dates),
    "eda_by_period": lambda i: profile.by_period(i.facts, i.indicators, i.dates),
    "eda_top_counts": lambda i: profile.top_counts(i.facts, i.indicators, i.dates),
    "eda_describe": eda_describe,
    "eda_sample": lambda i: profile.sample(lookup.star_extract(i.facts, i.indicators, i.dates)),
    "eda_period_mean": lambda i: profile.period_mean(i.facts, i.indicators, i.dates),
    "eda_quality": lambda i: profile.quality(i.signed.select("category", "value")),
}


def _bound(plan: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: plan(Inputs(spark, folder))


QUERIES: dict[str, Query] = {key: _bound(plan) for key, plan in _ON_INPUTS.items()}
