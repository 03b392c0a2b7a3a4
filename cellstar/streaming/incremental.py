"""Newly arrived workbooks and raw CSVs through the batch stages.

The file source remembers which paths it has handed out; the registry still decides
by content whether a file needs work. A load is named after its stream and batch: a batch that is
replayed meets its own first attempt, and no other stream's.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cellstar.plans import pipeline
from cellstar.sources import files
from cellstar.sources.store import Store

# What the binary file source delivers.
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint; it stays over restarts, and a new checkpoint has a new one."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(r.value for r in lines))["id"]


def load_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    return f"stream-{stream_id(spark, checkpoint)}-{batch_id}"


def _each_batch(arrived: DataFrame, checkpoint: str, process: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Hand every batch with its load id to ``process`` until everything that has arrived is done."""

    def step(batch: DataFrame, batch_id: int) -> None:
        try:
            process(batch, load_name(batch.sparkSession, checkpoint, batch_id))
        except RuntimeError as problem:
            # The run is recorded as failed; files that nobody can read must not hold up those behind them.
            if problem.args != (pipeline.NOTHING_READ,):
                raise

    return (
        arrived.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _arrivals(store: Store, folder: str, pattern: str, files_per_batch: int) -> DataFrame:
    return (
        store.spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def ingest_available(
    store: Store, folder: str, checkpoint: str, pattern: str = files.WORKBOOKS, files_per_batch: int = 1000
) -> StreamingQuery:
    """Process every workbook that has arrived, in batches, and stop.

    Streams over other folders, or with other checkpoints, may fill one store in turn. With a renewed
    checkpoint all files arrive again, and those that are loaded already are passed over.
    """

    def process(batch: DataFrame, load_id: str) -> None:
        pipeline.run_files(store, files.content_hashes(batch, "content"), load_id)

    return _each_batch(_arrivals(store, folder, pattern, files_per_batch), checkpoint, process)


def ingest_available_csv(
    store: Store, folder: str, checkpoint: str, pattern: str = "*.csv", files_per_batch: int = 1000
) -> StreamingQuery:
    """The same for raw sheet CSVs: the stream tells which have arrived, each batch reads its own as lines.

    No content passes through the stream, so a file may have any size; the driver gets the paths of one batch.
    """

    def process(batch: DataFrame, load_id: str) -> None:
        # A stream over a pattern of folders hands out a path once for each path of the batch.
        paths = [files.as_plain_path(r.path) for r in batch.distinct().collect()]
        if paths:
            pipeline.run_csv(store, paths, load_id)

    return _each_batch(_arrivals(store, folder, pattern, files_per_batch).select("path"), checkpoint, process)
