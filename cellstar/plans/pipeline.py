"""Files to star schema: ingest, transform, load.

Every stage is one set-wise job over all files of a load. What a stage wrote is read
back by the next, so no plan scans its source once per branch. A load becomes visible
when its files are committed at the very end; re-running it or running it twice adds
nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.functions import safe_name
from cellstar.operators import checks, sheets, warehouse
from cellstar.plans import book, quality
from cellstar.plans.runs import Run
from cellstar.schemas import LOADS
from cellstar.sources import csv_sheets, files, workbook
from cellstar.sources.store import Store, local_rows

PIPELINE = "sheet_etl"
SHEET = sheets.SHEET
# What a run fails with when each of its files has a failed check.
NOTHING_READ = "all files failed to process"


def together(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs side by side, so that short ones do not wait in line.

    Two jobs must not append to the same table: their commits would meet in one folder.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(job) for job in jobs]
        return [job.result() for job in started]


def _of(store: Store, table: str, load_id: str) -> DataFrame:
    return store.read(table).where(F.col("load_id") == load_id)


def read_files(spark: SparkSession, folder: str, pattern: str = files.WORKBOOKS) -> DataFrame:
    """``path, content, length`` and hash of the workbooks of a folder."""
    content = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.content_hashes(content, "content")


def ingest(store: Store, content: DataFrame, load_id: str, force: bool = False) -> DataFrame:
    """Read new and changed workbooks into the grid table; returns the files read.

    A file or sheet that cannot be decoded becomes a failed check; the rest goes on.
    When nothing at all could be read, the run fails.
    """
    with Run(store, PIPELINE, "ingestion", metadata={"load_id": load_id}) as run:
        # One read hashes every file; what is decided on and registered is this narrow table.
        seen = store.staged(
            f"{load_id}-seen",
            content.select(F.col("path").alias("file_path"), "file_hash", F.col("length").alias("file_size_bytes")).distinct(),
        )
        # What counts as done is a committed load, so a run that died is taken up again.
        done = store.live_loads().select(F.col("source_file").alias("file_path"), "file_hash")
        todo = files.to_process(seen, done, force)
        read = store.staged(f"{load_id}-read", workbook.decode_files(files.contents(todo)))
        return _take_in(store, run, load_id, read, seen)


def ingest_csv(
    store: Store, folder: str | list[str], load_id: str, pattern: str = "*.csv", force: bool = False
) -> DataFrame:
    """Read new and changed raw sheet CSVs, of a folder or of a list of paths, into the grid table; returns the files read.

    The files are read once, as lines. One that cannot be parsed becomes a failed check.
    """
    named = folder if isinstance(folder, str) else None
    with Run(store, PIPELINE, "ingestion", source_file=named, metadata={"load_id": load_id}) as run:
        lines = store.staged(f"{load_id}-lines", csv_sheets.read_lines(store.spark, folder, pattern))
        seen = store.staged(
            f"{load_id}-line-files", csv_sheets.line_files(lines).withColumnRenamed("source_file", "file_path")
        )
        done = store.live_loads().select(F.col("source_file").alias("file_path"), "file_hash")
        todo = files.to_process(seen, done, force).withColumnRenamed("file_path", "source_file")
        read = store.staged(f"{load_id}-read", csv_sheets.grid_of(lines, todo))
        now = seen.select("file_path", "file_hash", F.col("file_size").alias("file_size_bytes"))
        return _take_in(store, run, load_id, read, now)


def _take_in(store: Store, run: Run, load_id: str, read: DataFrame, now: DataFrame) -> DataFrame:
    """Grid rows and errors of the same written table into the store, with their checks and lineage."""
    errors = store.staged(f"{load_id}-errors", workbook.errors_of(read))
    grid = workbook.without_errors(read, errors)
    store.append("grid", grid, load_id)

    written = _of(store, "grid", load_id)
    rows, failed, *_ = together(
        written.count,
        lambda: not errors.isEmpty(),
        lambda: run.log_checks(error_metrics(errors, "ingestion_success", "raw").unionByName(raw_metrics(written), True)),
        lambda: run.track_lineage(raw_lineage(written)),
    )
    if failed and not rows:
        raise RuntimeError(NOTHING_READ)

    now = now.withColumn("file_name", files.file_name(F.col("file_path")))
    register(store, now, written, errors)
    run.complete("success", records_input=rows, records_processed=rows, records_loaded=rows)
    return written.select("source_file").distinct()


def error_metrics(errors: DataFrame, check: str, stage: str) -> DataFrame:
    """Failed-check rows of files or sheets that could not be processed."""
    stem = safe_name(F.concat_ws("_", files.file_name(F.col("source_file")), F.col("sheet")))
    return errors.select(
        F.concat(F.lit(f"{check}_"), stem).alias("check_name"),
        F.lit("consistency").alias("check_category"),
        F.concat(F.lit(f"{stage}_"), stem).alias("table_name"),
        F.lit(False).alias("passed"),
        F.lit(0.0).alias("metric_value"),
        F.lit(1.0).alias("threshold_value"),
        F.to_json(F.struct("error")).alias("details"),
    )


def raw_metrics(grid: DataFrame) -> DataFrame:
    measured = checks.raw_completeness(grid)
    stem = safe_name(F.concat_ws("_", files.file_name(F.col("source_file")), F.col("sheet")))
    return measured.select(
        F.concat_ws("_", "check_name", stem).alias("check_name"),
        F.lit("completeness").alias("check_category"),
        F.concat(F.lit("raw_"), stem).alias("table_name"),
        "passed",
        "metric_value",
        "threshold_value",
        "row_count",
        F.to_json(F.struct("source_file", "sheet", F.col("column_count").alias("columns"))).alias("details"),
    )


def _hop(rows: DataFrame, table: str, column: str, source, logic: str, kind: str, sheet=None) -> DataFrame:
    return rows.select(
        F.lit(table).alias("target_table"),
        F.lit(column).alias("target_column"),
        "source_file",
        (F.lit(None).cast("string") if sheet is None else sheet).alias("source_sheet"),
        source.cast("string").alias("source_column"),
        F.lit(logic).alias("transformation_logic"),
        F.lit(kind).alias("transformation_type"),
    )


def raw_lineage(grid: DataFrame) -> DataFrame:
    per_sheet = grid.select(*SHEET).distinct()
    return _hop(
        per_sheet, "raw_sheet", "all_columns", F.lit("all_columns"), "Rows of the sheet as read", "direct_copy",
        F.col("sheet"),
    )


def clean_lineage(layouts: DataFrame) -> DataFrame:
    hops = [
        ("indicator", F.col("id_name"), "Detected header, trimmed white space", "direct_copy"),
        ("year_label", F.lit("year_columns"), "Unpivoted period columns to rows", "unpivot"),
        ("value", F.lit("year_columns"), "Unpivoted values, removed commas, converted to numbers", "unpivot"),
    ]
    parts = [
        _hop(layouts, "clean_sheet", column, source, logic, kind, F.col("sheet"))
        for column, source, logic, kind in hops
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def register(store: Store, now: DataFrame, grid: DataFrame, errors: DataFrame) -> None:
    """Append the new registry entry of every file seen that could be read."""
    sheets_read = grid.groupBy("source_file", "sheet").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("cells")).alias("columns")
    )
    details = sheets_read.groupBy(F.col("source_file").alias("file_path")).agg(
        F.count(F.lit(1)).alias("sheet_count"),
        F.sum("rows").alias("row_count"),
        F.max("columns").cast("bigint").alias("column_count"),
        # As many names as the workbook has sheets.
        F.to_json(
            F.struct(
                F.array_sort(F.collect_list("sheet")).alias("sheet_names"),
                F.count(F.lit(1)).alias("sheet_count"),
            )
        ).alias("schema_fingerprint"),
    )
    unreadable = errors.where(F.col("sheet").isNull()).select(F.col("source_file").alias("file_path"))
    readable = now.join(unreadable, "file_path", "left_anti")
    entries = files.registered(readable, store.registry(), details, F.current_timestamp())
    store.append("source_files", entries.join(readable.select("file_path"), "file_path", "left_semi"))


def transform(store: Store, load_id: str, fallback: bool = False) -> None:
    """Grid of a load to cleaned measurements."""
    with Run(store, PIPELINE, "transform", metadata={"load_id": load_id}) as run:
        grid = _of(store, "grid", load_id)
        # Written first: Spark then knows how small the layouts are and joins accordingly.
        layouts = store.staged(f"{load_id}-layouts", sheets.layout_of(grid, fallback))

        cells = sheets.measured_cells(sheets.unpivot(grid, layouts))
        store.append("long", cells, load_id)

        written = _of(store, "long", load_id)
        long = written.where(F.col("value").isNotNull())
        idle = sheets.sheets_without_data(grid, long).withColumn("error", F.lit("no valid data"))
        measured = quality.domain_metrics(long.select("indicator", "year_label", "value"), f"transform_{load_id}")
        counts, *_ = together(
            written.agg(F.count(F.lit(1)).alias("read"), F.count("value").alias("kept")).first,
            lambda: run.log_checks(error_metrics(idle, "transform_success", "transform").unionByName(measured, True)),
            lambda: run.track_lineage(clean_lineage(layouts)),
        )
        run.complete(
            "success",
            records_input=counts.read,
            records_processed=counts.kept,
            records_loaded=counts.kept,
            records_rejected=counts.read - counts.kept,
        )


def load(store: Store, load_id: str, locations: DataFrame | None = None) -> None:
    """Cleaned measurements of a load into the star schema, committed file by file."""
    with Run(store, PIPELINE, "load", metadata={"load_id": load_id}) as run:
        long = _of(store, "long", load_id).where(F.col("value").isNotNull()).drop("text")
        together(lambda: add_indicators(store, load_id, long), lambda: add_dates(store, load_id, long))
        indicators, dates = store.read("dim_indicator"), store.read("dim_date")

        last = store.read("file_loads").agg(F.coalesce(F.max("max_fact_id"), F.lit(0))).scalar()
        offsets = store.staged(f"{load_id}-offsets", warehouse.sheet_offsets(long))
        keyed = warehouse.with_fact_keys(warehouse.with_fact_ids(long, offsets, last), indicators, dates, locations)
        facts = keyed.select(
            "fact_id",
            "indicator_id",
            "date_id",
            "location_id",
            "value",
            F.lit(None).alias("units"),
            F.lit(None).alias("notes"),
            "source_file",
            F.lit(load_id).alias("load_id"),
        )
        # Sorted inside each task, so that readers of one period or indicator skip row groups.
        store.append("facts", facts.sortWithinPartitions("date_id", "indicator_id"), load_id)

        sums = book.fact_states(_of(store, "facts", load_id), "source_file", "indicator_id", "date_id")
        store.append("fact_sums", sums, load_id)
        commit(store, load_id, _of(store, "fact_sums", load_id))
        checked = warehouse.committed_checks(store.live_loads(), indicators, dates)
        done = store.read("file_loads").where(F.col("load_id") == load_id)
        hops = _hop(
            done, "fact_indicator_values", "value", F.lit("value"), "Loaded from cleaned measurements", "direct_copy"
        )
        (n,), *_ = together(
            done.agg(F.coalesce(F.sum("fact_count"), F.lit(0))).first,
            lambda: run.log_checks(warehouse.completeness_gate(long).unionByName(checked)),
            lambda: run.track_lineage(hops),
        )
        run.complete("success", records_input=n, records_processed=n, records_loaded=n)


def add_indicators(store: Store, load_id: str, long: DataFrame) -> None:
    """Append the indicators not known yet; the measurements are read once for it."""
    known = store.read("dim_indicator")
    unknown = store.staged(f"{load_id}-indicators", warehouse.unknown_indicators(long, known))
    if not unknown.isEmpty():
        store.append("dim_indicator", warehouse.numbered_indicators(unknown, known))


def add_dates(store: Store, load_id: str, long: DataFrame) -> None:
    known = store.read("dim_date")
    unknown = store.staged(f"{load_id}-dates", warehouse.unknown_dates(long, known))
    if not unknown.isEmpty():
        store.append("dim_date", warehouse.numbered_dates(unknown, known))


def commit(store: Store, load_id: str, sums: DataFrame) -> None:
    """Make this load the live one of every file it holds, also of files left without facts.

    Counts are kept per file, so later checks need not read the facts again; they come from the
    load's sums, which are live or replaced together with the facts. The row in
    ``loads`` comes last: nothing written before it counts without it.
    """
    read = _of(store, "grid", load_id).select("source_file").distinct()
    counted = sums.groupBy("source_file").agg(
        F.sum("n").alias("fact_count"),
        F.sum(F.when(warehouse.orphan(), F.col("n")).otherwise(0)).alias("orphan_count"),
        F.max("last_fact_id").alias("max_fact_id"),
    )
    hashes = store.registry().select(F.col("file_path").alias("source_file"), "file_hash")
    entries = store.staged(
        f"{load_id}-files",
        read.join(counted, "source_file", "left")
        .join(hashes, "source_file", "left")
        .withColumn("load_id", F.lit(load_id))
        .withColumn("loaded_at", F.current_timestamp()),
    )
    earlier = store.live_loads().where(F.col("load_id") != load_id).select("source_file", "load_id")
    replaced = earlier.join(entries.select("source_file"), "source_file", "left_semi")
    together(
        lambda: store.append("file_loads", entries),
        lambda: store.append("superseded", replaced.withColumn("by_load_id", F.lit(load_id))),
    )
    publish(store, load_id)


def publish(store: Store, load_id: str) -> None:
    now = datetime.now(timezone.utc)
    done = local_rows(store.spark, LOADS, [{"load_id": load_id, "committed_at": now}])
    store.append("loads", done.coalesce(1))


def run(store: Store, folder: str, pattern: str = files.WORKBOOKS, force: bool = False, load_id: str | None = None) -> str | None:
    """All stages over a folder of workbooks; returns the load id, None when nothing was new."""
    load_id = load_id or uuid.uuid4().hex
    files.discover(store.spark, folder, pattern)
    return run_files(store, read_files(store.spark, folder, pattern), load_id, force)


def run_files(store: Store, content: DataFrame, load_id: str, force: bool = False) -> str | None:
    """All stages over ``path, content, length, file_hash`` rows; a load id that is committed adds nothing."""
    if store.is_committed(load_id) or ingest(store, content, load_id, force).isEmpty():
        return None
    transform(store, load_id)
    load(store, load_id)
    return load_id


def run_csv(
    store: Store, folder: str | list[str], load_id: str | None = None, pattern: str = "*.csv", force: bool = False
) -> str | None:
    """All stages over the raw CSVs of a folder, or of a list of paths."""
    load_id = load_id or uuid.uuid4().hex
    if store.is_committed(load_id) or ingest_csv(store, folder, load_id, pattern, force).isEmpty():
        return None
    transform(store, load_id)
    load(store, load_id)
    return load_id
