"""Streams that share a store, replayed batches, renewed checkpoints, and the folded event log."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellstar import schemas
from cellstar.plans import monitoring, pipeline
from cellstar.plans.runs import Run
from cellstar.sources.store import CommittedLoadError, Store, local_rows
from cellstar.streaming import run_states
from cellstar.streaming.incremental import ingest_available, ingest_available_csv, load_name
from tests.test_pipeline import facts, sheet
from tests.xlsx import write_workbook


def texts(store):
    return [f[0] for f in facts(store)]


def test_two_streams_and_a_renewed_checkpoint_lose_and_repeat_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        write_workbook(tmp_path / name / f"{name}.xlsx", {"s": sheet(["Beds", 1, 2])})
        ingest_available(store, str(tmp_path / name), str(tmp_path / f"point-{name}")).awaitTermination()
    assert texts(store) == ["a.xlsx", "a.xlsx", "b.xlsx", "b.xlsx"]
    assert {r.fact_count for r in store.live_loads().collect()} == {2}

    ingest_available(store, str(tmp_path / "a"), str(tmp_path / "renewed")).awaitTermination()
    assert texts(store) == ["a.xlsx", "a.xlsx", "b.xlsx", "b.xlsx"]
    write_workbook(tmp_path / "a" / "c.xlsx", {"s": sheet(["Beds", 3, None])})
    ingest_available(store, str(tmp_path / "a"), str(tmp_path / "renewed")).awaitTermination()
    ingest_available(store, str(tmp_path / "a"), str(tmp_path / "point-a")).awaitTermination()
    assert texts(store) == ["a.xlsx", "a.xlsx", "b.xlsx", "b.xlsx", "c.xlsx"]


def test_a_batch_that_died_or_is_replayed(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "out"))
    (tmp_path / "in").mkdir()
    write_workbook(tmp_path / "in" / "a.xlsx", {"s": sheet(["Beds", 1, 2])})
    point = str(tmp_path / "point")

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "publish", lost)
        with pytest.raises(Exception, match="lost"):
            ingest_available(store, str(tmp_path / "in"), point).awaitTermination()
    assert facts(store) == []
    ingest_available(store, str(tmp_path / "in"), point).awaitTermination()
    assert len(facts(store)) == 2

    name = load_name(spark, point, 0)
    assert [r.load_id for r in store.committed().collect()] == [name]
    assert pipeline.run_files(store, pipeline.read_files(spark, str(tmp_path / "in")), name, force=True) is None
    for table in ("grid", "long", "facts"):
        with pytest.raises(CommittedLoadError):
            store.append(table, store.read(table), name)
    assert len(facts(store)) == 2
    with pytest.raises(ValueError):
        store.append("facts", store.read("facts"))


def test_streamed_csvs(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    source = tmp_path / "raw [1]"
    source.mkdir()
    (source / "a{x}.csv").write_text('0,1,2\nYearly,,\nIndicator,2016/17,2017/18\nBeds,"1,200",7\n"Broken\nline",1,\n')
    point, folder = str(tmp_path / "point"), str(tmp_path / "raw*")
    ingest_available_csv(store, folder, point).awaitTermination()
    first = [("Beds", "2016/17", 1200.0), ("Beds", "2017/18", 7.0), ("Broken\nline", "2016/17", 1.0)]
    assert [f[1:] for f in facts(store)] == first
    for k in range(3):
        (source / f"b{k}.csv").write_text(f"0,1,2\nIndicator,2016/17,2017/18\nNurses,{k + 1},\n")
    (source / "bad.csv").write_text('Indicator,"2016/17\nx,1\n')
    ingest_available_csv(store, folder, point, files_per_batch=3).awaitTermination()
    assert sorted(f[1:] for f in facts(store)) == [*first, *[("Nurses", "2016/17", float(k + 1)) for k in range(3)]]
    (source / "bad.csv").unlink()
    ingest_available_csv(store, folder, str(tmp_path / "renewed")).awaitTermination()
    assert len(facts(store)) == 6
    failed = store.read("quality_metrics").where(~F.col("passed") & F.col("check_name").like("ingestion_success_bad%"))
    assert not failed.isEmpty()


def event(run, kind, day, **values):
    filled = dict.fromkeys(schemas.RUN_EVENTS.names) | {"run_id": run, "event": kind, "event_ts": datetime(2024, 1, day)}
    return filled | {"pipeline_name": "p", "pipeline_stage": "load"} | values


def states(rows):
    return sorted(map(str, monitoring.run_latest_state(rows.drop("load_id")).collect()))


def test_folded_events_are_the_log_itself(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    point = str(tmp_path / "point")

    def log(*events):
        store.append("run_events", local_rows(spark, schemas.RUN_EVENTS, list(events)).coalesce(1))
        run_states.fold_available(store, point).awaitTermination()

    log(event("a", "start", 1, status="running"), event("b", "start", 1, status="running"), event("c", "complete", 9, status="success", records_loaded=4))
    log(event("a", "complete", 3, status="failed", error_message="x"), event("a", "complete", 4, status="success"))
    late = lambda day: sorted(r.run_id for r in run_states.stalled_runs(store.read("run_states"), datetime(2024, 1, day), timedelta(days=1)).collect())
    assert late(2) == ["a", "b"] and late(5) == ["b"]
    # A late start, an earlier completion, and what was seen before.
    log(event("c", "start", 2, status="running"), event("c", "complete", 8, status="failed"), event("a", "start", 1, status="running"))
    assert states(store.read("run_states")) == states(store.read("run_events"))
    kinds = store.read("run_states").groupBy("run_id", "event").count().collect()
    assert {(r.run_id, r.event, r["count"]) for r in kinds} >= {("a", "start", 1), ("a", "complete", 1), ("c", "complete", 2)}
    rows = store.read("run_states").count()
    run_states.fold_available(store, point).awaitTermination()
    assert store.read("run_states").count() == rows

    run_states.fold_available(store, str(tmp_path / "renewed")).awaitTermination()
    assert states(store.read("run_states")) == states(store.read("run_events"))
    log(event("b", "complete", 5, status="success"))
    assert late(4) == ["b", "c"] and late(9) == []


def test_live_runs_are_folded(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    with Run(store, "p", "load") as run:
        run.complete("success", records_loaded=3)
    run_states.fold_available(store, str(tmp_path / "point")).awaitTermination()
    assert states(store.read("run_states")) == states(store.read("run_events"))


def test_a_batch_of_bad_files_does_not_stop_the_stream(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bad.csv").write_text('Indicator,"2016/17\nx,1\n')
    ingest_available_csv(store, str(tmp_path / "in"), str(tmp_path / "point")).awaitTermination()
    runs = monitoring.run_latest_state(store.read("run_events")).collect()
    assert [(r.status, r.pipeline_stage) for r in runs] == [("failed", "ingestion")] and facts(store) == []
