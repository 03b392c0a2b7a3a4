"""Views over run, quality, lineage and file metadata.

Every look-back takes ``as_of`` instead of the wall clock, so a result can be repeated.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstar.functions import percent

RUN_COLUMNS = [
    "pipeline_name",
    "pipeline_stage",
    "source_file",
    "status",
    "records_input",
    "records_processed",
    "records_loaded",
    "records_rejected",
    "error_message",
    "error_details",
    "metadata",
]


def _since(column: str, as_of: datetime, days: int) -> Column:
    return F.col(column) > F.lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def _newest(*names: str) -> list[Column]:
    first, *rest = names
    return [F.col(first).desc_nulls_first(), *[F.col(n).asc_nulls_last() for n in rest]]


def elapsed_seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1e6)


def run_latest_state(events: DataFrame) -> DataFrame:
    """Current state of every run from its event log.

    The first completion wins: a later, implicit one does not overwrite it.
    """
    detail = F.struct("event_ts", *[c for c in RUN_COLUMNS if c in events.columns])
    state = events.groupBy("run_id").agg(
        F.min(F.when(F.col("event") == "start", detail)).alias("start"),
        F.min(F.when(F.col("event") == "complete", detail)).alias("done"),
    )
    later = [c for c in RUN_COLUMNS if c in events.columns and c not in ("pipeline_name", "pipeline_stage", "source_file")]
    origin = [c for c in ("pipeline_name", "pipeline_stage", "source_file") if c in events.columns]
    return state.select(
        "run_id",
        *[F.col(f"start.{c}").alias(c) for c in origin],
        F.col("start.event_ts").alias("started_at"),
        F.col("done.event_ts").alias("completed_at"),
        *[F.coalesce(f"done.{c}", f"start.{c}").alias(c) for c in later],
    ).withColumn("execution_duration_seconds", elapsed_seconds("started_at", "completed_at"))


def pass_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
    ]


def _pass_rate(digits: int = 2) -> Column:
    return percent(F.col("passed_checks"), F.col("total_checks"), digits)


# Bands of a success or pass rate, and of a quality score.
RATE_BANDS = [(95, "OK"), (80, "WARN")]
SCORE_BANDS = [(95, "Excellent"), (90, "Good"), (85, "Fair")]


def band(value: Column, bands: list[tuple[int, str]], lowest: str) -> Column:
    (floor, name), *rest = bands
    label = F.when(value >= floor, name)
    for floor, name in rest:
        label = label.when(value >= floor, name)
    return label.otherwise(lowest)


def run_quality_score(metrics: DataFrame) -> DataFrame:
    """Share of passed checks per run, 0-100."""
    return (
        metrics.groupBy("run_id").agg(*pass_counts()).select("run_id", _pass_rate().alias("quality_score"))
    )


def score_bands(metrics: DataFrame) -> DataFrame:
    scored = run_quality_score(metrics)
    return scored.withColumn("band", band(F.col("quality_score"), SCORE_BANDS, "Poor"))


def run_summary(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Run rows with their checks per category; a run without checks keeps one row."""
    checks = metrics.groupBy("run_id", "check_category").agg(*pass_counts())
    return runs.join(checks, "run_id", "left").select(
        "run_id",
        "pipeline_name",
        "pipeline_stage",
        "status",
        "records_processed",
        "records_loaded",
        "execution_duration_seconds",
        "check_category",
        "total_checks",
        "passed_checks",
        _pass_rate(1).alias("pass_pct"),
    )


def v_recent_runs(runs: DataFrame, limit: int = 100) -> DataFrame:
    return (
        runs.orderBy(*_newest("started_at", "run_id"))
        .limit(limit)
        .withColumn("duration_seconds", elapsed_seconds("started_at", "completed_at"))
        .drop("execution_duration_seconds")
    )


def v_pipeline_health(runs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    per = (
        runs.where(_since("started_at", as_of, days))
        .groupBy("pipeline_name")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            F.count_if(F.col("status") == "success").alias("successful_runs"),
            F.count_if(F.col("status") == "failed").alias("failed_runs"),
            F.avg(elapsed_seconds("started_at", "completed_at")).alias("avg_duration_seconds"),
            F.max("started_at").alias("last_run_at"),
        )
    )
    return per.withColumn("success_rate", percent(F.col("successful_runs"), F.col("total_runs")))


def pipeline_health(runs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return v_pipeline_health(runs, as_of, days).orderBy(*_newest("last_run_at", "pipeline_name"))


def health_bands(runs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    health = pipeline_health(runs, as_of, days)
    return health.select(
        "pipeline_name",
        "total_runs",
        "success_rate",
        band(F.coalesce("success_rate", F.lit(0.0)), RATE_BANDS, "FAIL").alias("band"),
    )


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    return runs.orderBy(*_newest("started_at", "run_id")).limit(limit)


def monitor_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return (
        runs.orderBy(*_newest("started_at", "run_id"))
        .limit(limit)
        .select(
            "run_id",
            "pipeline_name",
            "pipeline_stage",
            "status",
            "started_at",
            F.coalesce("execution_duration_seconds", F.lit(0.0)).alias("duration_sec"),
            "records_processed",
            "records_loaded",
        )
    )


def failed_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return (
        runs.where(F.col("status") == "failed")
        .orderBy(*_newest("started_at", "run_id"))
        .limit(limit)
        .select("run_id", "pipeline_name", "pipeline_stage", "started_at", "error_message")
    )


def slow_runs(runs: DataFrame, seconds: float = 60, limit: int = 10) -> DataFrame:
    return (
        runs.where(F.col("execution_duration_seconds") > seconds)
        .orderBy(*_newest("execution_duration_seconds", "run_id"))
        .limit(limit)
        .select("run_id", "pipeline_name", "pipeline_stage", "started_at", "execution_duration_seconds")
    )


def score_by_run(runs: DataFrame, metrics: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Quality score of the runs completed lately; 0 for a run without checks."""
    done = runs.where(_since("completed_at", as_of, days))
    return (
        done.join(run_quality_score(metrics), "run_id", "left")
        .select(
            "run_id", "pipeline_name", "started_at", F.coalesce("quality_score", F.lit(0.0)).alias("quality_score")
        )
        .orderBy(*_newest("started_at", "run_id"))
    )


def v_quality_trend(metrics: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (
        metrics.where(_since("checked_at", as_of, days))
        .groupBy(F.to_date("checked_at").alias("check_date"), "check_category")
        .agg(*pass_counts())
        .withColumn("pass_rate", _pass_rate())
        .orderBy(F.col("check_date").desc(), F.col("check_category").asc_nulls_last())
    )


def quality_by_category(metrics: DataFrame, as_of: datetime, days: int = 7, digits: int = 2) -> DataFrame:
    if not 1 <= days <= 90:
        raise ValueError("days must be between 1 and 90")
    return (
        metrics.where(_since("checked_at", as_of, days))
        .groupBy("check_category")
        .agg(*pass_counts())
        .withColumn("pass_rate", _pass_rate(digits))
        .orderBy(F.col("check_category").asc_nulls_last())
    )


def quality_bands(metrics: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    rates = quality_by_category(metrics, as_of, days, digits=1)
    return rates.withColumn("band", band(F.coalesce("pass_rate", F.lit(0.0)), RATE_BANDS, "FAIL"))


def _identity(metrics: DataFrame) -> list[str]:
    """Columns that settle ties between checks of the same moment."""
    return [c for c in ("metric_id", "run_id", "check_name", "table_name", "column_name") if c in metrics.columns]


def v_failed_checks(metrics: DataFrame, runs: DataFrame, limit: int = 100) -> DataFrame:
    """Newest failed checks with the pipeline and file of their run."""
    failed = metrics.where(~F.col("passed"))
    return (
        failed.join(runs.select("run_id", "pipeline_name", "source_file"), "run_id")
        .orderBy(*_newest("checked_at", *_identity(metrics)))
        .limit(limit)
        .select(
            "check_name",
            "check_category",
            "table_name",
            "column_name",
            "source_file",
            "metric_value",
            "threshold_value",
            "details",
            "checked_at",
            "pipeline_name",
        )
    )


def recent_failures(metrics: DataFrame, as_of: datetime, days: int = 7, limit: int = 20) -> DataFrame:
    if not 1 <= days <= 90:
        raise ValueError("days must be between 1 and 90")
    return (
        metrics.where(~F.col("passed") & _since("checked_at", as_of, days))
        .orderBy(*_newest("checked_at", *_identity(metrics)))
        .limit(limit)
        .select(
            "check_name", "check_category", "table_name", "column_name", "metric_value", "threshold_value", "checked_at"
        )
    )


def lineage_lookup(lineage: DataFrame, table: str, column: str, limit: int = 50) -> DataFrame:
    """Newest lineage records of one field."""
    kept = [
        "source_file", "source_sheet", "source_column", "transformation_logic", "transformation_type", "recorded_at",
    ]
    rest = ["source_file", "source_column", "transformation_logic", "transformation_type"]
    return (
        lineage.where((F.col("target_table") == table) & (F.col("target_column") == column))
        .select(*kept)
        .orderBy(*_newest("recorded_at", *rest))
        .limit(limit)
    )


def field_lineage(lineage: DataFrame, table: str, column: str) -> DataFrame:
    """All distinct origins of one field, newest first."""
    return (
        lineage.where((F.col("target_table") == table) & (F.col("target_column") == column))
        .select("source_file", "source_column", "transformation_logic", F.col("recorded_at").alias("last_updated"))
        .distinct()
        .orderBy(*_newest("last_updated", "source_file", "source_column"))
    )


def table_lineage(lineage: DataFrame, table: str) -> DataFrame:
    kept = ["target_column", "source_file", "source_column", "transformation_type", "transformation_logic"]
    return lineage.where(F.col("target_table") == table).select(*kept).distinct().orderBy(*kept)


def source_file_listing(files: DataFrame) -> DataFrame:
    """Registered files, last processed first, never processed last."""
    return files.orderBy(F.col("last_processed").desc_nulls_last(), "file_path")


def dashboard_bundle(
    runs: DataFrame, metrics: DataFrame, files: DataFrame, as_of: datetime
) -> dict[str, DataFrame]:
    """The parts of the monitoring dashboard, each a DataFrame of its own."""
    return {
        "pipeline_health": pipeline_health(runs, as_of),
        "recent_runs": recent_runs(runs, 5),
        "quality_by_category": quality_by_category(metrics, as_of),
        "failed_checks": v_failed_checks(metrics, runs, 5),
        "source_files": source_file_listing(files),
    }


def dashboard_rows(bundle: dict[str, DataFrame]) -> DataFrame:
    """The dashboard as one table: section, item, a count, a rate and a time."""

    def rows(section: str, item: Column, number: Column, rate: Column, at: Column) -> DataFrame:
        return bundle[section].select(
            F.lit(section).alias("section"),
            item.cast("string").alias("item"),
            number.cast("bigint").alias("number"),
            rate.cast("double").alias("rate"),
            at.alias("at"),
        )

    never = F.lit(None).cast("timestamp_ntz")
    parts = [
        rows("pipeline_health", F.col("pipeline_name"), F.col("total_runs"), F.col("success_rate"), F.col("last_run_at")),
        rows(
            "recent_runs", F.col("run_id"), F.col("records_loaded"), F.col("execution_duration_seconds"), F.col("started_at")
        ),
        rows("quality_by_category", F.col("check_category"), F.col("total_checks"), F.col("pass_rate"), never),
        rows("failed_checks", F.col("check_name"), F.lit(1), F.col("metric_value"), F.col("checked_at")),
        rows("source_files", F.col("file_path"), F.col("processing_count"), F.lit(None), F.col("last_processed")),
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
