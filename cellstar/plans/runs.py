"""Writing run, quality and lineage metadata."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar import schemas
from cellstar.plans import monitoring
from cellstar.sources.store import Store, local_rows

STATUSES = ["running", "success", "failed", "skipped"]


def _now() -> datetime:
    return datetime.now(timezone.utc)


class Run:
    """One tracked run. The first explicit completion counts.

    As a context manager it completes on exit, as failed when an exception passes
    through; the exception is never swallowed.
    """

    def __init__(
        self,
        store: Store,
        pipeline_name: str,
        pipeline_stage: str,
        source_file: str | None = None,
        metadata: dict | None = None,
    ):
        self.store = store
        self.run_id = str(uuid.uuid4())
        self.origin = {
            "pipeline_name": pipeline_name,
            "pipeline_stage": pipeline_stage,
            "source_file": source_file,
        }
        self.completed = False
        self._event("start", status="running", metadata=json.dumps(metadata) if metadata else None)

    def _event(self, event: str, **values) -> None:
        record = {"run_id": self.run_id, "event": event, "event_ts": _now(), **self.origin, **values}
        self._append("run_events", schemas.RUN_EVENTS, [record])

    def _append(self, table: str, schema, records: list[dict]) -> None:
        filled = [{name: record.get(name) for name in schema.names} for record in records]
        self.store.append(table, local_rows(self.store.spark, schema, filled).coalesce(1))

    def complete(
        self,
        status: str = "success",
        records_input: int | None = None,
        records_processed: int | None = None,
        records_loaded: int | None = None,
        records_rejected: int | None = None,
        error_message: str | None = None,
        error_details: dict | None = None,
    ) -> None:
        if status not in STATUSES:
            raise ValueError(f"status must be one of {', '.join(STATUSES)}")
        if self.completed:
            return
        self._event(
            "complete",
            status=status,
            records_input=records_input,
            records_processed=records_processed,
            records_loaded=records_loaded,
            records_rejected=records_rejected,
            error_message=error_message,
            error_details=json.dumps(error_details) if error_details else None,
        )
        self.completed = True

    def log_checks(self, metrics: DataFrame) -> None:
        """Append a batch of metric rows."""
        have = set(metrics.columns)
        filled = metrics.select(
            F.lit(self.run_id).alias("run_id"),
            F.current_timestamp().alias("checked_at"),
            *[
                F.col(c) if c in have else F.lit(None).alias(c)
                for c in schemas.QUALITY_METRICS.names
                if c not in ("run_id", "checked_at")
            ],
        )
        self.store.append("quality_metrics", filled)

    def log_check(self, check_name: str, passed: bool, check_category: str = "general", **values) -> None:
        record = {
            "run_id": self.run_id,
            "check_name": check_name,
            "passed": passed,
            "check_category": check_category,
            "checked_at": _now(),
            **values,
        }
        if isinstance(record.get("details"), dict):
            record["details"] = json.dumps(record["details"])
        self._append("quality_metrics", schemas.QUALITY_METRICS, [record])

    def track_lineage(self, hops: DataFrame) -> None:
        """Append field lineage; missing columns take their defaults."""
        have = set(hops.columns)
        defaults = {
            "run_id": F.lit(self.run_id),
            "target_schema": F.lit("health"),
            "recorded_at": F.current_timestamp(),
            "transformation_type": F.lit("direct_copy"),
        }
        self.store.append(
            "field_lineage",
            hops.select(
                *[
                    F.col(c) if c in have else defaults.get(c, F.lit(None)).alias(c)
                    for c in schemas.FIELD_LINEAGE.names
                ]
            ),
        )

    def quality_score(self) -> DataFrame:
        metrics = self.store.read("quality_metrics").where(F.col("run_id") == self.run_id)
        return monitoring.run_quality_score(metrics)

    def summary(self) -> DataFrame:
        mine = F.col("run_id") == self.run_id
        runs = monitoring.run_latest_state(self.store.read("run_events").where(mine))
        return monitoring.run_summary(runs, self.store.read("quality_metrics").where(mine))

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, problem, trace) -> bool:
        if problem is None:
            self.complete("success")
        else:
            self.complete("failed", error_message=str(problem), error_details={"exception_type": kind.__name__})
        return False


def seed_rules(store: Store, rules: DataFrame) -> None:
    """Add rules whose name is not stored yet."""
    known = store.read("quality_rules").select("rule_name")
    store.append("quality_rules", rules.join(known, "rule_name", "left_anti"))
