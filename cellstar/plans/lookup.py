"""Parameterised questions: search, metadata, series, rankings, dataset state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellstar.functions import exact_mean, round2
from cellstar.operators.series import with_previous
from cellstar.plans.book import mean, merged, reduce_facts


def _in_range(name: str, value: int, low: int, high: int | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be between {low} and {high}" if high else f"{name} must be at least {low}")


def _one_of(name: str, value: str, allowed: list[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}")


SORT_FIELDS = ["indicator_name", "period_label", "year", "value"]


def indicators(
    facts: DataFrame,
    indicator_dim: DataFrame,
    dates: DataFrame,
    limit: int = 100,
    offset: int = 0,
    indicator: str | None = None,
    period: str | None = None,
    year: int | None = None,
    sort_by: str = "indicator_name",
    sort_order: str = "asc",
) -> DataFrame:
    """Filtered, sorted page of measurements; ``indicator`` matches anywhere, ignoring case."""
    _in_range("limit", limit, 1, 1000)
    _in_range("offset", offset, 0)
    _one_of("sort_by", sort_by, SORT_FIELDS)
    _one_of("sort_order", sort_order, ["asc", "desc"])

    names = indicator_dim.select("indicator_id", "indicator_name")
    if indicator:
        names = names.where(F.contains(F.lower("indicator_name"), F.lower(F.lit(indicator))))
    periods = dates.select("date_id", "period_label", "year")
    if period:
        periods = periods.where(F.col("period_label") == period)
    if year is not None:
        periods = periods.where(F.col("year") == year)

    first = F.col(sort_by).asc_nulls_last() if sort_order == "asc" else F.col(sort_by).desc_nulls_first()
    rest = [F.col(c).asc_nulls_last() for c in [*SORT_FIELDS, "fact_id"] if c != sort_by]
    return (
        facts.select("fact_id", "indicator_id", "date_id", "value")
        .join(names, "indicator_id")
        .join(periods, "date_id")
        .orderBy(first, *rest)
        .offset(offset)
        .limit(limit)
        .select("indicator_name", "period_label", "year", F.col("value").cast("double").alias("value"))
    )


def star_extract(facts: DataFrame, indicator_dim: DataFrame, dates: DataFrame) -> DataFrame:
    """Every fact with its names."""
    return (
        facts.join(indicator_dim.select("indicator_id", "indicator_name"), "indicator_id")
        .join(dates.select("date_id", "period_label", "year"), "date_id")
        .select(
            "fact_id",
            "indicator_name",
            "period_label",
            "year",
            F.col("value").cast("double").alias("value"),
            "units",
            "notes",
        )
    )


def metadata_totals(facts: DataFrame, indicator_dim: DataFrame) -> DataFrame:
    per = facts.groupBy("indicator_id").agg(F.count("fact_id").alias("n"))
    return indicator_dim.join(per, "indicator_id", "left").agg(
        F.count("indicator_id").alias("total_indicators"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
    )


def indicator_metadata(facts: DataFrame, indicator_dim: DataFrame, dates: DataFrame) -> DataFrame:
    """Coverage of every indicator, also of those without a fact."""
    pairs = facts.groupBy("indicator_id", "date_id").agg(
        F.count("fact_id").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    per = (
        pairs.join(dates.select("date_id", "period_label"), "date_id", "left")
        .groupBy("indicator_id")
        .agg(
            F.sum("n").alias("n"),
            F.min("period_label").alias("first_period"),
            F.max("period_label").alias("last_period"),
            F.min("low").cast("double").alias("low"),
            F.max("high").cast("double").alias("high"),
        )
    )
    return (
        indicator_dim.join(per, "indicator_id", "left")
        .select(
            "indicator_name",
            "category",
            F.coalesce("n", F.lit(0)).alias("data_points"),
            "first_period",
            "last_period",
            F.when(F.col("low").isNotNull(), F.array("low", "high")).alias("value_range"),
        )
        .orderBy(F.col("indicator_name").asc_nulls_last())
    )


def change_percent(value: Column, previous: Column) -> Column:
    """Change against ``previous`` in percent; NULL when that is NULL or zero.

    The difference is exact, the division is not: per row, a decimal one costs too much.
    """
    return round2(F.try_divide((value - previous).cast("double") * 100, previous.cast("double")))


def all_timeseries(facts: DataFrame, indicator_dim: DataFrame, dates: DataFrame) -> DataFrame:
    """Every series in period order with the previous value and the change."""
    rows = facts.select("fact_id", "indicator_id", "date_id", "value").join(
        indicator_dim.select("indicator_id"), "indicator_id", "left_semi"
    )
    lagged = with_previous(
        rows, dates, "indicator_id", "date_id", ["year", "period_label"], "fact_id", "value"
    )
    return lagged.join(indicator_dim.select("indicator_id", "indicator_name"), "indicator_id").select(
        "indicator_name",
        F.col("period_label").alias("period"),
        "year",
        "fact_id",
        F.col("value").cast("double").alias("value"),
        F.col("prev_value").cast("double").alias("prev_value"),
        change_percent(F.col("value"), F.col("prev_value")).alias("change_pct"),
    )


def timeseries(facts: DataFrame, indicator_dim: DataFrame, dates: DataFrame, name: str) -> DataFrame:
    """One indicator's series; the name is compared ignoring case."""
    wanted = indicator_dim.where(F.lower("indicator_name") == F.lower(F.lit(name)))
    rows = all_timeseries(facts, wanted, dates)
    order = [F.col(c).asc_nulls_last() for c in ("year", "period", "fact_id", "value")]
    return rows.orderBy(*order)


def series_statistics(facts: DataFrame, indicator_dim: DataFrame, dates: DataFrame) -> DataFrame:
    """Average, extremes and trend of every series.

    The trend compares the last with the first non-null value in the order of period and
    fact id; both come out of one hash aggregation, without sorting a series.
    """
    pairs = facts.where(F.col("value").isNotNull()).groupBy("indicator_id", "date_id").agg(
        F.count("value").alias("n"),
        F.sum("value").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.min_by("value", "fact_id").alias("first"),
        F.max_by("value", "fact_id").alias("last"),
    )
    slot = F.struct(F.col("year").isNull(), "year", "period_label", "date_id")
    per = (
        pairs.join(dates.select("date_id", "year", "period_label"), "date_id")
        .groupBy("indicator_id")
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.min_by("first", slot).alias("first"),
            F.max_by("last", slot).alias("last"),
        )
    )
    trend = (
        F.when(F.col("n") < 2, "insufficient_data")
        .when(F.col("last") > F.col("first"), "increasing")
        .otherwise("decreasing")
    )
    return per.join(indicator_dim.select("indicator_id", "indicator_name"), "indicator_id").select(
        "indicator_name",
        F.col("n").alias("data_points"),
        round2(exact_mean(F.col("total"), F.col("n"))).alias("average"),
        F.col("low").cast("double").alias("min_value"),
        F.col("high").cast("double").alias("max_value"),
        trend.alias("trend"),
    )


def rankings(
    facts: DataFrame,
    indicator_dim: DataFrame,
    dates: DataFrame,
    period: str | None = None,
    limit: int = 10,
    metric: str = "total_value",
) -> DataFrame:
    """Best indicators of a period (default: the greatest label) and the gap to the next better.

    ``change_from_previous`` is that gap in percent, not a change over time.
    """
    _in_range("limit", limit, 1, 50)
    _one_of("metric", metric, ["total_value", "avg_value"])
    chosen = F.lit(period) if period else dates.agg(F.max("period_label")).scalar()
    wanted = dates.where(F.col("period_label") == chosen).select("date_id", "period_label")

    # Facts of other periods go before they are grouped.
    of_period = facts.join(wanted.select("date_id"), "date_id", "left_semi")
    pairs = reduce_facts(of_period, "indicator_id", "date_id").join(wanted, "date_id")
    per = merged(pairs, "indicator_id", "period_label").join(indicator_dim, "indicator_id")
    score = F.col("total") if metric == "total_value" else mean()
    best = [F.col("score").desc_nulls_first(), F.col("indicator_name").asc_nulls_last()]
    top = per.withColumn("score", score).orderBy(*best).limit(limit)
    # The gap only looks one rank up, so the window needs no more than the ``limit`` rows.
    ranked = Window.orderBy(*best)
    return (
        top.withColumn("rank", F.row_number().over(ranked).cast("bigint"))
        .withColumn("above", F.lag("score").over(ranked))
        .select(
            "period_label",
            "rank",
            "indicator_name",
            round2(F.col("score")).alias("value"),
            "category",
            change_percent(F.col("score"), F.col("above")).alias("change_from_previous"),
        )
    )


def dataset_stats(facts: DataFrame, indicator_dim: DataFrame, dates: DataFrame) -> DataFrame:
    pairs = reduce_facts(facts, "indicator_id", "date_id")
    known = pairs.join(indicator_dim.select("indicator_id"), "indicator_id").join(
        dates.select("date_id", "period_label"), "date_id"
    )
    return known.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        F.count_distinct("indicator_id").alias("unique_indicators"),
        F.count_distinct("period_label").alias("unique_periods"),
        round2(exact_mean(F.sum("total"), F.sum("n_values"))).alias("avg_value"),
        F.min("low").cast("double").alias("min_value"),
        F.max("high").cast("double").alias("max_value"),
    )


# Weight and threshold of the quality score.
SCORE_WEIGHT = 0.9
MIN_COMPLETENESS = 0.95


def quality_snapshot(facts: DataFrame) -> DataFrame:
    v = F.col("value")
    counts = facts.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(v.isNull()).alias("null_values"),
        F.count_if(v == 0).alias("zero_values"),
        F.count_if(v < 0).alias("negative_values"),
        round2(exact_mean(F.sum(v), F.count(v))).alias("avg_value"),
        F.min(v).cast("double").alias("min_value"),
        F.max(v).cast("double").alias("max_value"),
    )
    complete = 1 - F.coalesce(F.try_divide(F.col("null_values"), F.col("total_records")), F.lit(0.0))
    return counts.select(
        "*",
        round2(complete * SCORE_WEIGHT).alias("overall_quality_score"),
        F.when(complete > MIN_COMPLETENESS, "PASSED").otherwise("WARNING").alias("data_completeness"),
    )
