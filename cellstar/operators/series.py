"""Previous value in a series that may be far larger than one task can sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 1_000_000
#: Chunks by rows at most, the steps their marks are searched in, and the accuracy of the sketch that sets them.
MARKS = 2_048
STEP = 64
ACCURACY = 20_000


def _piece(key: Column, marks: Column) -> Column:
    """How many of the sorted marks lie below the key, looked up in two steps."""
    coarse = F.filter(marks, lambda m, i: i % STEP == STEP - 1)
    blocks = F.size(F.filter(coarse, lambda m: m < key)) * STEP
    return blocks + F.size(F.filter(F.slice(marks, blocks + 1, STEP), lambda m: m < key))


def _in_ranges(rows: DataFrame, row_id: str, value: str, cuts: int) -> DataFrame:
    """``rows`` with ``_chunk``: ranges of the id, then of the value of rows without one, ``cuts`` + 1 of each at most."""
    rid, amount = F.col(row_id).cast("double"), F.col(value).cast("double")
    shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
    none = F.array().cast("array<double>")
    marks = rows.agg(
        F.coalesce(F.percentile_approx(rid, shares, ACCURACY), none).alias("ids"),
        F.coalesce(F.percentile_approx(F.when(rid.isNull(), amount), shares, ACCURACY), none).alias("values"),
    )
    ids, values = F.col("_marks.ids"), F.col("_marks.values")
    rows = rows.withColumn("_marks", marks.select(F.struct("ids", "values")).scalar())
    # Cuts keep the order of rows: ids first, then rows without one by value, then those without either.
    late = F.size(ids) + 1 + _piece(amount, values)
    chunk = F.when(rid.isNull(), F.when(amount.isNull(), F.size(ids) + F.size(values) + 2).otherwise(late)).otherwise(_piece(rid, ids))
    return rows.withColumn("_chunk", chunk).drop("_marks")


def with_previous(
    rows: DataFrame,
    slots: DataFrame,
    series: str,
    slot: str,
    slot_order: list[str],
    row_id: str,
    value: str,
    prev_name: str = "prev_value",
    chunk_rows: int = CHUNK_ROWS,
    keep_chunk: bool = False,
) -> DataFrame:
    """``LAG(value)`` per ``series`` in the order (slot_order, slot, row_id, value).

    ``slots`` lists the slots (periods) with their ``slot_order`` columns; rows of other
    slots are left out. A series is cut into chunks: its slots, and within a slot ranges
    of ``row_id`` that hold about ``chunk_rows`` rows of the whole input, or its share of
    MARKS once there are more; rows without an id come last, in ranges of ``value``. The
    large window runs per chunk; a small one over one tail row per chunk supplies what
    precedes the first row of each chunk. ``keep_chunk`` keeps the number of the range as ``_chunk``.
    """
    # Counted first: a sketch has as many marks as there are cuts, and what fits one chunk needs none.
    cuts = min(-(-rows.count() // chunk_rows), MARKS) - 1
    chunked = _in_ranges(rows, row_id, value, cuts) if cuts > 0 else rows.withColumn("_chunk", F.lit(0))

    place = [series, slot, "_chunk"]
    row_order = [F.col(row_id).asc_nulls_last(), F.col(value).asc_nulls_last()]
    inside = Window.partitionBy(*place).orderBy(*row_order)
    numbered = (
        chunked.withColumn("_first", F.row_number().over(inside) == 1)
        .withColumn("_last", F.lead(F.lit(True)).over(inside).isNull())
        .withColumn("_lag", F.lag(value).over(inside))
    )

    # The same shuffled rows feed both branches; this one keeps a row per chunk.
    tails = numbered.where("_last").select(*place, F.col(value).alias("_tail"))
    placed = tails.join(slots.select(slot, *slot_order), slot)
    ordered = [F.col(c).asc_nulls_last() for c in slot_order]
    across = Window.partitionBy(series).orderBy(*ordered, F.col(slot), F.col("_chunk"))
    carried = placed.select(*place, *slot_order, F.lag("_tail").over(across).alias("_carried"))

    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag"))
    found = numbered.join(carried, place).withColumn(prev_name, previous).drop("_first", "_last", "_lag", "_carried")
    return found if keep_chunk else found.drop("_chunk")
