"""Exact quantiles without gathering all values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
#: Equal ranges into which the values near a quantile are dealt to be counted.
RANGES = 1024


def quantile_row(rows: DataFrame, column: str, probabilities: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row: ``n`` and ``quantiles``, linearly interpolated, in the order of ``probabilities``.

    The built-in exact percentile keeps every distinct value in one buffer. Here a mergeable
    sketch first brackets each quantile (its rank error is at most rows / accuracy). Then values
    inside the brackets are counted one by one, and those between two brackets together, with
    their ends. Running counts go by ranges of value, so two reads and no task per probability.
    """
    wanted = sorted(set(probabilities))
    values = rows.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    margin = 2.0 / accuracy
    low = [max(0.0, p - margin) for p in wanted]
    high = [min(1.0, p + margin) for p in wanted]
    sketch = values.agg(F.count("v").alias("n"), F.percentile_approx("v", [*low, *high], accuracy).alias("marks"))
    n, marks = sketch.select("n").scalar(), sketch.select("marks").scalar()
    los, his = ([F.get(marks, F.lit(i + at)) for i in range(len(wanted))] for at in (0, len(wanted)))

    v = F.col("v")
    zone = sum((F.when(v > hi, 1).otherwise(0) for hi in his), F.lit(0))
    near = F.coalesce(*[F.when(v.between(lo, hi), F.lit(True)) for lo, hi in zip(los, his)], F.lit(False))
    counted = values.select("v", zone.alias("zone"), near.alias("near")).groupBy(
        "zone", "near", F.when(F.col("near"), v).alias("at")
    ).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))

    lo, hi = (F.get(marks, F.col("zone") + at) for at in (0, len(wanted)))
    part = F.when(F.col("near") & (lo < hi), F.coalesce(F.width_bucket("at", lo, hi, F.lit(RANGES)), F.lit(0))).otherwise(0)
    counted = counted.withColumn("part", part)
    place = ["zone", "near", "part"]
    # At most RANGES + 2 rows per probability and one more per gap, so always small enough to ship.
    sums = counted.groupBy(*place).agg(F.sum("c").alias("s"))
    earlier = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*place, F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*place).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") + F.coalesce(F.sum("c").over(inside), F.lit(0))
    ranked = counted.join(F.broadcast(starts), place).withColumn("first", first)

    def value_at(rank: Column) -> Column:
        """Between two brackets only the ends are known, and only they can be asked for."""
        end = F.col("first") + F.col("c") - 1
        return F.max(F.when(rank == end, F.col("hi")).when((rank >= F.col("first")) & (rank < end), F.col("lo")))

    def quantile(p: float) -> Column:
        rank = F.lit(p) * (n - 1)
        below, above = value_at(F.floor(rank)), value_at(F.ceil(rank))
        return F.when(below == above, below).otherwise(below + (above - below) * (rank - F.floor(rank)))

    found = ranked.agg(F.sum("c").alias("n"), *[quantile(p).alias(f"q{i}") for i, p in enumerate(wanted)])
    return found.select("n", F.array(*[F.col(f"q{wanted.index(p)}") for p in probabilities]).alias("quantiles"))


def exact_quantiles(
    rows: DataFrame, column: str, probabilities: list[float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row per probability: ``(probability, quantile)``; none without values."""
    found = quantile_row(rows, column, probabilities, accuracy).where(F.col("n") > 0)
    pairs = F.arrays_zip(F.array(*map(F.lit, probabilities)).alias("probability"), F.col("quantiles").alias("quantile"))
    return found.select(F.inline(pairs).alias("probability", "quantile"))
