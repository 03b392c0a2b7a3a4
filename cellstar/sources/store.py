"""Parquet tables under one folder, written by appending.

A state that changes is a log whose newest entry counts, and rows of a load that did
not commit are never looked at. Only the partition of one load is ever replaced, by a
second attempt at the same load, so a job that dies can simply be run again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from cellstar import schemas

TABLES: dict[str, StructType] = {
    "grid": StructType([*schemas.GRID.fields, StructField("load_id", StringType())]),
    "long": StructType([*schemas.LONG.fields, StructField("load_id", StringType())]),
    "dim_date": schemas.DIM_DATE,
    "dim_indicator": schemas.DIM_INDICATOR,
    "dim_location": schemas.DIM_LOCATION,
    "facts": schemas.FACT,
    "fact_sums": schemas.FACT_SUMS,
    "loads": schemas.LOADS,
    "superseded": schemas.SUPERSEDED,
    "file_loads": schemas.FILE_LOADS,
    "run_events": schemas.RUN_EVENTS,
    "run_states": StructType([*schemas.RUN_EVENTS.fields, StructField("load_id", StringType())]),
    "quality_metrics": schemas.QUALITY_METRICS,
    "field_lineage": schemas.FIELD_LINEAGE,
    "source_files": schemas.SOURCE_FILES,
    "quality_rules": schemas.QUALITY_RULES,
}
# Large tables are laid out by load, so a stage reads only what it was given.
BY_LOAD = {"grid", "long", "facts", "fact_sums", "run_states"}


def local_rows(spark: SparkSession, schema: StructType, records: list[dict]) -> DataFrame:
    """A handful of driver-side records as a local relation, which starts no Python worker."""
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)


class CommittedLoadError(ValueError):
    """Rows were to replace those of a load that others see already."""


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        """The table, empty when nothing was written yet."""
        schema = TABLES[table]
        try:
            return self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.names)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return local_rows(self.spark, schema, [])

    def append(self, table: str, rows: DataFrame, load_id: str | None = None) -> None:
        """Add rows; in a table laid out by load they replace what that load wrote before it was committed."""
        schema = TABLES[table]
        if (table in BY_LOAD) != (load_id is not None):
            raise ValueError(f"{table}: a load id belongs to tables laid out by load, and to no other")
        if load_id is not None:
            if self.is_committed(load_id):
                raise CommittedLoadError(f"{table}: load {load_id} is committed")
            rows = rows.withColumn("load_id", F.lit(load_id))
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        if table in BY_LOAD:
            writer = typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("load_id").parquet(self.path(table))
        else:
            typed.write.mode("append").parquet(self.path(table))

    def staged(self, name: str, rows: DataFrame) -> DataFrame:
        """Write an intermediate result and read it back, so that its size is known."""
        path = self.path(f"staging/{name}")
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def committed(self) -> DataFrame:
        return self.read("loads").select("load_id").distinct()

    def is_committed(self, load_id: str) -> bool:
        return not self.committed().where(F.col("load_id") == load_id).isEmpty()

    def live_loads(self) -> DataFrame:
        """The newest committed load of every file."""
        columns = [c for c in schemas.FILE_LOADS.names if c != "source_file"]
        newest = F.max_by(F.struct(*columns), F.struct("loaded_at", "load_id"))
        loads = self.read("file_loads").join(self.committed(), "load_id", "left_semi")
        return loads.groupBy("source_file").agg(newest.alias("l")).select("source_file", "l.*")

    def live(self, table: str) -> DataFrame:
        """Rows of committed loads, without what a later load of the same file replaced.

        Both lists are short (one row per load, one per replaced file), so the large table
        is filtered where it is read.
        """
        by = self.committed().withColumnRenamed("load_id", "by_load_id")
        gone = self.read("superseded").join(by, "by_load_id", "left_semi").select("source_file", "load_id")
        return (
            self.read(table)
            .join(self.committed(), "load_id", "left_semi")
            .join(gone, ["source_file", "load_id"], "left_anti")
        )

    def registry(self) -> DataFrame:
        """Newest entry per source file."""
        columns = [c for c in schemas.SOURCE_FILES.names if c != "file_path"]
        newest = F.max_by(F.struct(*columns), F.struct("processing_count", "last_processed"))
        return (
            self.read("source_files").groupBy("file_path").agg(newest.alias("s")).select("file_path", "s.*")
            .select(*schemas.SOURCE_FILES.names)
        )
