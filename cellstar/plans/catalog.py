"""The warehouse and its metadata under their usual names, for plain SQL.

After :func:`register`, queries written against the tables, views and functions of
the warehouse run with ``spark.sql``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from cellstar.plans import book, monitoring
from cellstar.sources.store import Store

QUALITY_SCORE = """
CREATE OR REPLACE TEMPORARY FUNCTION get_quality_score(wanted STRING)
RETURNS DOUBLE
RETURN SELECT coalesce(round(100.0 * count_if(passed) / nullif(count(*), 0), 2), 0)
       FROM data_quality_metrics WHERE run_id = wanted
"""
FIELD_LINEAGE = """
CREATE OR REPLACE TEMPORARY FUNCTION get_field_lineage(wanted_table STRING, wanted_column STRING)
RETURNS TABLE (source_file STRING, source_column STRING, transformation_logic STRING, last_updated TIMESTAMP)
RETURN SELECT DISTINCT source_file, source_column, transformation_logic, recorded_at
       FROM field_lineage WHERE target_table = wanted_table AND target_column = wanted_column
       ORDER BY recorded_at DESC
"""


def register(store: Store, as_of: datetime | None = None) -> None:
    """Temporary views and functions over the current state of a store."""
    as_of = as_of or datetime.now(timezone.utc)
    facts, indicators, dates = store.live("facts"), store.read("dim_indicator"), store.read("dim_date")
    sums = store.live("fact_sums")
    metrics = store.read("quality_metrics")
    runs = monitoring.run_latest_state(store.read("run_events"))
    views = {
        "fact_indicator_values": facts,
        "dim_indicator": indicators,
        "dim_date": dates,
        "dim_location": store.read("dim_location"),
        "pipeline_runs": runs,
        "data_quality_metrics": metrics,
        "field_lineage": store.read("field_lineage"),
        "source_files": store.registry(),
        "quality_rules": store.read("quality_rules"),
        "indicator_summary": book.indicator_summary_of(sums, indicators, dates),
        "monthly_summary": book.monthly_summary_of(sums, indicators, dates),
        "v_recent_pipeline_runs": monitoring.v_recent_runs(runs),
        "v_pipeline_health": monitoring.v_pipeline_health(runs, as_of),
        "v_quality_trend": monitoring.v_quality_trend(metrics, as_of),
        "v_failed_quality_checks": monitoring.v_failed_checks(metrics, runs),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    store.spark.sql(QUALITY_SCORE)
    store.spark.sql(FIELD_LINEAGE)
