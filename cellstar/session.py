"""Session settings the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "cellstar", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session; ``extra`` wins over the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the cluster names it.

    Only a session that names none (local tests) gets a private folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return os.path.join(tempfile.gettempdir(), "cellstar-checkpoints")


_WRITTEN: dict[str, StructType] = {}


def written_once(name: str, rows: DataFrame) -> DataFrame:
    """``rows`` as a table in the shared folder, written on first use in this session.

    Unlike a cached DataFrame it survives the loss of an executor, and unlike a
    checkpoint it keeps column pruning and lets Spark know its size.
    """
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark)}/cellstar-{spark.sparkContext.applicationId}/{name}"
    if path not in _WRITTEN:
        rows.write.mode("overwrite").parquet(path)
        _WRITTEN[path] = rows.schema
    return spark.read.schema(_WRITTEN[path]).parquet(path)
