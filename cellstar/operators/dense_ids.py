"""Consecutive surrogate keys without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the key's MD5 that pick a bucket: 16 ** 3 buckets, each numbered apart.
BUCKET_DIGITS = 3


def with_dense_ids(rows: DataFrame, key: str, id_name: str, start: Column | int = 0) -> DataFrame:
    """Add ids ``start + 1 … start + n`` to rows whose ``key`` is unique.

    Keys are spread over 4096 hash buckets and numbered inside their bucket; a running
    total over the bucket sizes turns that into one sequence. The same set of keys
    always gets the same ids.
    """
    start = F.lit(start) if isinstance(start, int) else start
    bucketed = rows.withColumn("_bucket", F.substring(F.md5(F.col(key)), 1, BUCKET_DIGITS))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_rank", rank)
        # At most 4096 rows whatever the input, so always small enough to ship.
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(id_name, (start + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_offset", "_rank")
    )
