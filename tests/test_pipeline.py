import pytest
from pyspark.sql import functions as F

from cellstar.plans import book, catalog, monitoring, pipeline, quality, runs
from cellstar.plans.runs import Run
from cellstar.sources import files
from cellstar.sources.store import Store
from cellstar.streaming.incremental import ingest_available
from tests.xlsx import write_workbook


def sheet(*rows):
    return [["Yearly table"], ["Indicator", "2016/17", "2017/18"], *rows]


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_workbook(source / "a.xlsx", {"north": sheet(["Beds", "1,200", 7], ["Nurses", "n.a.", 3]), "notes": [["text"]]})
    write_workbook(source / "b.xlsx", {"south": sheet(["beds", 1, 2])})
    return source


def facts(store):
    live = store.live("facts")
    named = live.join(store.read("dim_indicator"), "indicator_id").join(store.read("dim_date"), "date_id")
    return sorted(
        (r.source_file.rsplit("/")[-1], r.indicator_name, r.period_label, float(r.value)) for r in named.collect()
    )


FIRST = [
    ("a.xlsx", "Beds", "2016/17", 1200.0),
    ("a.xlsx", "Beds", "2017/18", 7.0),
    ("a.xlsx", "Nurses", "2017/18", 3.0),
    ("b.xlsx", "Beds", "2016/17", 1.0),
    ("b.xlsx", "Beds", "2017/18", 2.0),
]


def state(store):
    return monitoring.run_latest_state(store.read("run_events"))


def test_only_chosen_files_are_read_whatever_their_names(spark, tmp_path):
    source = tmp_path / "odd"
    source.mkdir()
    names = ["a[1].xlsx", "b {x,y}.xlsx", "c%20d.xlsx", "e.xlsx"]
    for name in names:
        write_workbook(source / name, {"north": sheet(["Beds", 1, 2])})
    store = Store(spark, str(tmp_path / "out"))
    assert pipeline.run(store, str(source)) is not None
    assert {f[0] for f in facts(store)} == set(names)

    seen = pipeline.read_files(spark, str(source)).withColumnRenamed("path", "file_path")
    some = files.contents(seen.where("file_path not like '%e.xlsx'"))
    assert sorted(r.path.rsplit("/")[-1] for r in some.collect()) == names[:3]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert files.contents(seen.limit(0)).collect() == []


def test_load_twice_is_load_once_and_changes_replace(spark, tmp_path, folder):
    store = Store(spark, str(tmp_path / "out"))
    assert pipeline.run(store, str(folder)) is not None
    assert facts(store) == FIRST
    dims = store.read("dim_indicator").count(), store.read("dim_date").count()
    assert dims == (2, 2)

    assert pipeline.run(store, str(folder)) is None
    assert facts(store) == FIRST

    write_workbook(folder / "b.xlsx", {"south": sheet(["Doctors", 9, None])})
    assert pipeline.run(store, str(folder)) is not None
    assert facts(store) == [*FIRST[:3], ("b.xlsx", "Doctors", "2016/17", 9.0)]
    assert store.read("dim_indicator").count() == 3
    ids = [r.fact_id for r in store.read("facts").collect()]
    assert len(set(ids)) == len(ids)

    assert pipeline.run(store, str(folder), force=True) is not None
    assert facts(store) == [*FIRST[:3], ("b.xlsx", "Doctors", "2016/17", 9.0)]

    files = {r.file_name: r for r in store.registry().collect()}
    assert files["a.xlsx"].processing_count == 4 and files["a.xlsx"].sheet_count == 2
    assert files["b.xlsx"].processing_count == 4 and files["b.xlsx"].status == "processed"

    done = state(store).where(F.col("pipeline_stage") == "transform").orderBy("started_at").first()
    assert (done.status, done.records_input, done.records_loaded, done.records_rejected) == ("success", 6, 5, 1)
    failed = store.read("quality_metrics").where(~F.col("passed")).select("check_name").distinct()
    assert "transform_success_a_xlsx_notes" in {r.check_name for r in failed.collect()}
    checks = {r.check_name for r in store.read("quality_metrics").collect()}
    assert {"warehouse_completeness_value", "warehouse_referential_integrity", "warehouse_fact_count"} <= checks
    lineage = monitoring.table_lineage(store.read("field_lineage"), "clean_sheet")
    assert {r.target_column for r in lineage.collect()} == {"indicator", "year_label", "value"}


def test_summaries_are_kept_by_loads(spark, tmp_path, folder, monkeypatch):
    """Equal to a full recompute after a replaced file, a forced load, a dead one; no fact is read for them."""
    store = Store(spark, str(tmp_path / "out"))

    def check():
        indicators, dates, live = store.read("dim_indicator"), store.read("dim_date"), store.live("facts")
        catalog.register(store)
        for name, full in (("indicator_summary", book.indicator_summary), ("monthly_summary", book.monthly_summary)):
            view = spark.table(name)
            want = full(live, indicators, dates).select(*view.columns)
            assert sorted(map(str, view.collect())) == sorted(map(str, want.collect()))
            assert not [f for f in view.inputFiles() if "/facts/" in f]
        kept = store.live_loads().agg(F.sum("fact_count"), F.max("max_fact_id")).first()
        assert tuple(kept) == tuple(live.agg(F.count("*"), F.max("fact_id")).first())
        return {r.indicator_name: (r.total_measurements, r.std_dev) for r in spark.table("indicator_summary").collect()}

    pipeline.run(store, str(folder))
    assert check() == {"Beds": (4, 598.34), "Nurses": (1, None)}
    write_workbook(folder / "b.xlsx", {"south": sheet(["Doctors", 9, None], ["beds", 7, 7])})
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "publish", lost)
        with pytest.raises(OSError):
            pipeline.run(store, str(folder), load_id="second")
    assert check() == {"Beds": (4, 598.34), "Nurses": (1, None)}
    pipeline.run(store, str(folder), load_id="second")
    assert check()["Doctors"] == (1, None)
    pipeline.run(store, str(folder), force=True)
    assert check()["Beds"][0] == 4


def test_states_keep_the_digits_of_values_far_from_zero(spark):
    rows = [(k, k % 7, 1, float(10**9 + k % 5) / 1000) for k in range(1000)]
    facts = spark.createDataFrame(rows, "fact_id long, date_id long, indicator_id long, value double")
    facts = facts.withColumn("value", F.col("value").cast("decimal(38,6)"))
    states = book.fact_states(facts, "indicator_id", "date_id")
    got = book.merged_states(states, "indicator_id").first()
    want = facts.agg(F.var_pop(F.col("value").cast("double")) * F.count("*")).first()[0]
    assert got.n == 1000 and got.squares == pytest.approx(want, rel=1e-6)
    assert book.merged_states(states.limit(0), "indicator_id").collect() == []


def test_a_bad_file_is_reported_and_the_rest_goes_on(spark, tmp_path, folder):
    (folder / "bad.xlsx").write_bytes(b"junk")
    store = Store(spark, str(tmp_path / "out"))
    pipeline.run(store, str(folder))
    assert facts(store) == FIRST
    failed = store.read("quality_metrics").where("check_name = 'ingestion_success_bad_xlsx'").collect()
    assert len(failed) == 1 and "BadZipFile" in failed[0].details
    assert {r.file_name for r in store.registry().collect()} == {"a.xlsx", "b.xlsx"}


def test_only_bad_files_fail_the_run(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "bad.xlsx").write_bytes(b"junk")
    store = Store(spark, str(tmp_path / "out"))
    with pytest.raises(RuntimeError):
        pipeline.run(store, str(source))
    run = state(store).first()
    assert run.status == "failed" and "RuntimeError" in run.error_details


def lost(*_):
    raise OSError("lost")


def test_a_run_that_died_is_taken_up_again(spark, tmp_path, folder, monkeypatch):
    """Dying just before the last step leaves the old state; the same load id may be used again."""
    store = Store(spark, str(tmp_path / "out"))
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "publish", lost)
        with pytest.raises(OSError):
            pipeline.run(store, str(folder), load_id="first")
    assert facts(store) == []
    pipeline.run(store, str(folder), load_id="first")
    assert facts(store) == FIRST

    write_workbook(folder / "b.xlsx", {"south": sheet(["Doctors", 9, None])})
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "publish", lost)
        with pytest.raises(OSError):
            pipeline.run(store, str(folder), load_id="second")
    assert facts(store) == FIRST
    pipeline.run(store, str(folder), load_id="third")
    assert facts(store) == [*FIRST[:3], ("b.xlsx", "Doctors", "2016/17", 9.0)]


def test_raw_csv_folder(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    (source / "b.csv").write_bytes("0,1,2\nIndicator,2016/17,2017/18\ncafés,3,x\n".encode("latin-1"))
    (source / "a_north.csv").write_text('0,1,2\nYearly,,\nIndicator,2016/17,2017/18\nBeds,"1,200",7\n')
    store = Store(spark, str(tmp_path / "out"))
    (source / "c.csv").write_text('Indicator,"2016/17\nx,1\n')
    assert pipeline.ingest_csv(store, str(source), "one").count() == 2
    pipeline.transform(store, "one")
    pipeline.load(store, "one")
    assert [f[1:] for f in facts(store)] == [
        ("Beds", "2016/17", 1200.0), ("Beds", "2017/18", 7.0), ("cafés", "2016/17", 3.0),
    ]
    assert sorted(r.file_name for r in store.registry().collect()) == ["a_north.csv", "b.csv"]
    (source / "c.csv").unlink()
    assert pipeline.ingest_csv(store, str(source), "two").isEmpty()


def test_first_completion_wins(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    with Run(store, "p", "load", source_file="f", metadata={"k": 1}) as run:
        run.log_check("c1", True, "validity", metric_value=1.0)
        run.log_check("c2", False, "validity", details={"why": "x"})
        run.complete("failed", records_input=5, error_message="explicit")
    row = state(store).first()
    assert (row.status, row.records_input, row.error_message) == ("failed", 5, "explicit")
    assert row.execution_duration_seconds > 0
    assert run.quality_score().first().quality_score == 50.0
    assert run.summary().first().pass_pct == 50.0
    with pytest.raises(ValueError):
        run.complete("unknown")


def test_exceptions_pass_through_and_are_recorded(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    with pytest.raises(KeyError):
        with Run(store, "p", "load"):
            raise KeyError("gone")
    row = state(store).first()
    assert row.status == "failed" and row.error_details == '{"exception_type": "KeyError"}'


def test_rules_are_seeded_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "out"))
    runs.seed_rules(store, quality.seed_rules(spark))
    runs.seed_rules(store, quality.seed_rules(spark))
    assert store.read("quality_rules").count() == 4


def test_streamed_arrivals(spark, tmp_path, folder):
    store = Store(spark, str(tmp_path / "out"))
    checkpoint = str(tmp_path / "checkpoint")
    ingest_available(store, str(folder), checkpoint).awaitTermination()
    assert facts(store) == FIRST
    write_workbook(folder / "c.xlsx", {"west": sheet(["Beds", 5, None])})
    ingest_available(store, str(folder), checkpoint).awaitTermination()
    assert facts(store) == [*FIRST, ("c.xlsx", "Beds", "2016/17", 5.0)]
