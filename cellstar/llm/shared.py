"""Helpers of the operators: intermediate tables, and connected components of links."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in short slices, so that a task holds few long texts as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def staged(rows: DataFrame) -> DataFrame:
    """Write ``rows`` to a new table in the shared folder and read it back.

    It cuts the lineage and survives lost executors, and later readers prune its columns.
    """
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def by_place(rows: DataFrame) -> DataFrame:
    """``rows`` with columns c0, c1, ...: no name of theirs, also one with a dot, can clash or be misread then."""
    return rows.toDF(*[f"c{k}" for k in range(len(rows.columns))])


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link to another; the component is its smallest node.

    Alternating large-star and small-star steps: each node hands its neighbours on to the
    smallest node it knows, so the rows never outnumber the links, and a hub is one row per
    task before it is joined. What is joined is written first, so that Spark can split a hub's
    links. Stops when a round changes nothing.
    """
    pair = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    now = staged(pair.where("hi <> lo").distinct())
    mark = None
    while True:
        found = now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if found[0] == 0 or tuple(found) == mark:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        mark = tuple(found)
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = staged(both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")))
        low = staged(large.groupBy("hi").agg(F.min("lo").alias("m")))
        ends = F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct("hi", F.col("m").alias("lo")))
        small = large.join(low, "hi").select(F.inline(ends)).where("hi <> lo")
        now = staged(small.distinct())
