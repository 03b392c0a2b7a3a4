"""Repeated rows and repeated keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
_NARROW_COLUMNS = 4


def _narrow(rows: DataFrame, columns: list[str]) -> bool:
    kinds = [rows.schema[c].dataType for c in columns]
    return len(kinds) <= _NARROW_COLUMNS and all(isinstance(k, _FIXED_WIDTH) for k in kinds)


def _encoded(rows: DataFrame, column: str) -> Column:
    """Text that differs whenever the values differ: its length, then the value; ``-`` for NULL."""
    kind, value = rows.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0).cast(kind)  # minus zero equals zero
    if isinstance(kind, T.BinaryType):
        value = F.base64(value)
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _keys(rows: DataFrame, columns: list[str], name: str) -> list[Column]:
    """What to group on so that rows equal on ``columns`` meet; NULL equals NULL.

    Long keys travel as their SHA-256 digest, so whole rows are never shuffled.
    """
    nested = any(isinstance(rows.schema[c].dataType, _NESTED) for c in columns)
    if nested or _narrow(rows, columns):
        return [F.col(c) for c in columns]
    return [F.unhex(F.sha2(F.concat(*[_encoded(rows, c) for c in columns]), 256)).alias(name)]


def _group_sizes(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``_n`` per group of equal rows.

    Counts are combined on the map side: a group that holds a large share of all rows
    reaches its reducer as one row per task.
    """
    return rows.groupBy(*_keys(rows, columns, "_digest")).agg(F.count(F.lit(1)).alias("_n"))


def repeated_groups(rows: DataFrame, columns: list[str], count_name: str = "n") -> DataFrame:
    """Groups equal on ``columns`` (NULL equals NULL) that occur more than once."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def surplus_rows(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, ``n``: rows beyond the first of each group of equal rows."""
    sizes = _group_sizes(rows, columns or rows.columns)
    return sizes.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n"))


def rows_with_repeated_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row, ``n``: all rows whose key occurs more than once."""
    sizes = _group_sizes(rows, keys).where(F.col("_n") > 1)
    return sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n"))


def repeat_profile(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row, ``n_duplicates`` and ``n_repeated_keys``: both counts from one scan.

    Equal rows share their key, so they are counted first and the counts are then
    merged per key.
    """
    if any(isinstance(rows.schema[c].dataType, _NESTED) for c in rows.columns):
        return surplus_rows(rows).select(
            F.col("n").alias("n_duplicates"), rows_with_repeated_key(rows, keys).scalar().alias("n_repeated_keys")
        )
    key = _keys(rows, keys, "_key")
    key_names = ["_key"] if len(key) == 1 and not _narrow(rows, keys) else keys
    equal = rows.groupBy(*_keys(rows, rows.columns, "_row"), *[k for k in key if not _narrow(rows, rows.columns)])
    sizes = equal.agg(F.count(F.lit(1)).alias("_n"))
    per_key = sizes.groupBy(*key_names).agg(F.sum("_n").alias("_k"), F.sum(F.col("_n") - 1).alias("_surplus"))
    return per_key.agg(
        F.coalesce(F.sum("_surplus"), F.lit(0)).cast("bigint").alias("n_duplicates"),
        F.coalesce(F.sum(F.when(F.col("_k") > 1, F.col("_k"))), F.lit(0)).cast("bigint").alias("n_repeated_keys"),
    )
