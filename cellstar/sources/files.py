"""File discovery, content hashes and change detection against a registry."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.schemas import SOURCE_FILES

# Fixed value: hash recorded for a registered file that no longer exists.
MISSING_HASH = "file_not_found"

# Both workbook formats are found; one that cannot be decoded is reported, not passed over.
WORKBOOKS = "*.xls*"
# Signs of a path that would be read as a pattern.
_PATTERN_SIGNS = re.compile(r"[\\\[\]{}*?]")


def discover(spark: SparkSession, folder: str, pattern: str = WORKBOOKS) -> DataFrame:
    """``path, length, modificationTime`` of matching files; reads no content."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    if found.isEmpty():
        raise FileNotFoundError(f"no file matches {pattern} in {folder}")
    return found


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def snapshot(spark: SparkSession, folder: str, pattern: str = WORKBOOKS) -> DataFrame:
    """``file_path, file_name, file_hash, file_size_bytes`` of the files in a folder."""
    content = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return content.select(
        F.col("path").alias("file_path"),
        file_name(F.col("path")).alias("file_name"),
        F.md5("content").alias("file_hash"),
        F.col("length").alias("file_size_bytes"),
    )


def content_hashes(files: DataFrame, content: str) -> DataFrame:
    return files.withColumn("file_hash", F.md5(F.col(content)))


def as_plain_path(path: str) -> str:
    """``path`` such that a reader takes no sign of it for a pattern."""
    return _PATTERN_SIGNS.sub(r"\\\g<0>", path)


def contents(chosen: DataFrame) -> DataFrame:
    """``path, content`` of the files in ``file_path``, and no others are read.

    The driver gets the paths, as it does when Spark lists a folder; contents are never joined.
    """
    paths = [r.file_path for r in chosen.select("file_path").collect()]
    if not paths:
        return chosen.select(F.col("file_path").alias("path"), F.lit(b"").alias("content"))
    return chosen.sparkSession.read.format("binaryFile").load([as_plain_path(p) for p in paths]).select("path", "content")


def detect_changes(now: DataFrame, registry: DataFrame) -> DataFrame:
    """State of every file seen now or registered: new, changed, unchanged or missing."""
    old = registry.select("file_path", F.col("file_hash").alias("old_hash"), "processing_count")
    joined = now.join(old, "file_path", "full_outer")
    state = (
        F.when(F.col("old_hash").isNull(), "new")
        .when(F.col("file_hash").isNull(), "missing")
        .when(F.col("file_hash") == F.col("old_hash"), "unchanged")
        .otherwise("changed")
    )
    seen = F.when(state == "missing", 0).otherwise(1)
    return joined.select(
        "file_path",
        state.alias("state"),
        F.coalesce("file_hash", F.lit(MISSING_HASH)).alias("file_hash"),
        (F.coalesce("processing_count", F.lit(0)) + seen).cast("bigint").alias("processing_count"),
    )


def to_process(now: DataFrame, registry: DataFrame, force: bool = False) -> DataFrame:
    """Files worth reading: all when forced, else those new or changed."""
    if force:
        return now
    known = registry.select("file_path", "file_hash")
    return now.join(known, ["file_path", "file_hash"], "left_anti")


def registered(now: DataFrame, registry: DataFrame, details: DataFrame, at: Column) -> DataFrame:
    """Next registry snapshot.

    ``details`` has ``file_path, sheet_count, row_count, column_count,
    schema_fingerprint`` of the files just read. A new or changed file takes its new
    details, an unchanged one only counts once more, one not seen now stays as it is.
    """
    was = registry.select([F.col(c).alias(c if c == "file_path" else f"was_{c}") for c in SOURCE_FILES.names])
    joined = now.join(details, "file_path", "left").join(was, "file_path", "full_outer")
    seen = F.col("file_hash").isNotNull()
    same = F.coalesce(F.col("file_hash") == F.col("was_file_hash"), F.lit(False))
    fresh = seen & ~same

    def either(column: str, condition: Column = fresh) -> Column:
        return F.when(condition, F.col(column)).otherwise(F.col(f"was_{column}")).alias(column)

    return joined.select(
        "file_path",
        F.coalesce("file_name", "was_file_name").alias("file_name"),
        F.coalesce("file_hash", "was_file_hash").alias("file_hash"),
        either("file_size_bytes"),
        either("sheet_count"),
        either("row_count"),
        either("column_count"),
        F.coalesce("was_first_seen", at).alias("first_seen"),
        F.when(seen, at).otherwise(F.col("was_last_processed")).alias("last_processed"),
        (F.coalesce("was_processing_count", F.lit(0)) + F.when(seen, 1).otherwise(0))
        .cast("bigint")
        .alias("processing_count"),
        either("schema_fingerprint"),
        F.when(seen, "processed").otherwise(F.col("was_status")).alias("status"),
    )
