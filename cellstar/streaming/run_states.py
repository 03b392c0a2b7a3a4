"""The event log of runs, folded as it grows.

A keyed state holds the first start and the first completion of each run. What improves a state is written as an event again, so the folded
log reads like the log it comes from, a row per run and kind. Folding takes the smallest
event of a kind: it may see events twice, in any order, or start over, and ends in the same states.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cellstar import schemas
from cellstar.plans import monitoring
from cellstar.sources.store import Store
from cellstar.streaming.incremental import load_name

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_KINDS = ("start", "complete")
# Times are kept as microseconds: state and rows come to Python with different ideas of a time zone.
_EVENTS = T.StructType([T.StructField(f.name, T.LongType()) if f.name == "event_ts" else f for f in schemas.RUN_EVENTS.fields])
_DETAIL = T.StructType([f for f in _EVENTS.fields if f.name not in ("run_id", "event")])
_STATE = T.StructType([T.StructField(kind, _DETAIL) for kind in _KINDS])


def _rank(detail: tuple) -> tuple:
    """Orders details field by field, nulls first."""
    return tuple((v is not None, v) for v in detail)


class _FirstOfEachKind(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("first", _STATE)

    def _row(self, key: tuple, kind: str, detail: tuple) -> Row:
        values = dict(zip(_DETAIL.names, detail, strict=True))
        return Row(**{"run_id": key[0], "event": kind, **values})

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        stored = self._state.get()
        held = dict(zip(_KINDS, stored, strict=True)) if stored is not None else dict.fromkeys(_KINDS)
        better = set()
        for row in rows:
            kind, detail = row["event"], tuple(row[name] for name in _DETAIL.names)
            if kind in held and (held[kind] is None or _rank(detail) < _rank(tuple(held[kind]))):
                held[kind] = detail
                better.add(kind)
        if not better:
            return
        self._state.update(tuple(None if held[k] is None else tuple(held[k]) for k in _KINDS))
        for kind in sorted(better):
            yield self._row(key, kind, held[kind])

    def close(self) -> None:
        pass


def fold_available(store: Store, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Fold the run events that have been logged since the last call into ``run_states``, and stop.

    Rows of a batch replace what its first attempt wrote. A renewed checkpoint folds the whole log
    again, to the same states.
    """
    spark = store.spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    events = (
        spark.readStream.schema(schemas.RUN_EVENTS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(store.path("run_events"))
    )
    counted = events.withColumn("event_ts", F.unix_micros("event_ts"))
    folded = counted.groupBy("run_id").transformWithState(_FirstOfEachKind(), _EVENTS, "Update", "None")
    folded = folded.withColumn("event_ts", F.timestamp_micros("event_ts"))

    def write(batch: DataFrame, batch_id: int) -> None:
        store.append("run_states", batch, load_name(batch.sparkSession, checkpoint, batch_id))

    return (
        folded.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def stalled_runs(states: DataFrame, as_of: datetime, after: timedelta = timedelta(hours=6)) -> DataFrame:
    """(run_id, pipeline_name, pipeline_stage, started_at) of runs that had not completed ``after`` their start, at ``as_of``.

    ``states`` are folded or unfolded events.
    """
    runs = monitoring.run_latest_state(states)
    open_then = F.col("completed_at").isNull() | (F.col("completed_at") > F.lit(as_of))
    found = runs.where(open_then & (F.col("started_at") <= F.lit(as_of - after)))
    return found.select("run_id", "pipeline_name", "pipeline_stage", "started_at")
