"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def narrow(table: DataFrame, column: str) -> Column:
    """The vector column in floats if it has floats, else in doubles: what is shuffled stays as small as it came."""
    kind = table.select(F.col(f"`{column}`").alias("v")).schema["v"].dataType
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(f"`{column}`").cast("array<float>" if floats else "array<double>")


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number per row (node); stable once written."""
    return rows.withColumn("node", F.monotonically_increasing_id())


def matrix(table: pa.Table, column: str, kind: type) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(values), -1)
