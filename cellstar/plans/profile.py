"""Exploratory profile of the star extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.functions import exact_mean, percent, round2
from cellstar.operators.quantiles import quantile_row
from cellstar.operators.repeats import surplus_rows
from cellstar.plans.book import mean, merged, reduce_facts


def _named_pairs(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        reduce_facts(facts, "indicator_id", "date_id")
        .join(indicators.select("indicator_id", "indicator_name"), "indicator_id")
        .join(dates.select("date_id", "period_label", "year"), "date_id")
    )


def overall(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    return _named_pairs(facts, indicators, dates).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        F.count_distinct("indicator_name").alias("unique_indicators"),
        F.count_distinct("period_label").alias("time_periods"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.min("low").cast("double").alias("min_value"),
        F.max("high").cast("double").alias("max_value"),
    )


def by_period(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    per = merged(_named_pairs(facts, indicators, dates), "period_label")
    return per.select("period_label", F.col("n").alias("records")).orderBy("period_label")


def top_counts(facts: DataFrame, indicators: DataFrame, dates: DataFrame, limit: int = 10) -> DataFrame:
    per = merged(_named_pairs(facts, indicators, dates), "indicator_name").select("indicator_name", "n")
    total = per.agg(F.sum("n")).scalar()
    return (
        per.orderBy(F.col("n").desc(), F.col("indicator_name").asc_nulls_last())
        .limit(limit)
        .select("indicator_name", F.col("n").alias("records"), percent(F.col("n"), total).alias("percentage"))
    )


def describe(rows: DataFrame, column: str = "value") -> DataFrame:
    """count, mean, std, min, quartiles, max of one column."""
    quartiles = quantile_row(rows, column, [0.25, 0.5, 0.75]).select("quantiles").scalar()
    v = F.col(column)
    return rows.agg(
        F.count(v).alias("count"),
        exact_mean(F.sum(v), F.count(v)).cast("double").alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).cast("double").alias("min"),
        F.max(v).cast("double").alias("max"),
    ).select(
        "count",
        "mean",
        "std",
        "min",
        F.get(quartiles, F.lit(0)).alias("p25"),
        F.get(quartiles, F.lit(1)).alias("p50"),
        F.get(quartiles, F.lit(2)).alias("p75"),
        "max",
    )


def sample(extract: DataFrame, limit: int = 10) -> DataFrame:
    """First records in a fixed order."""
    order = [F.col(c).asc_nulls_last() for c in ("fact_id", "indicator_name", "period_label", "value")]
    return extract.orderBy(*order).limit(limit).select("indicator_name", "period_label", "value")


def period_mean(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    per = merged(_named_pairs(facts, indicators, dates), "period_label")
    return per.select("period_label", round2(mean()).alias("avg_value")).orderBy("period_label")


def quality(rows: DataFrame, column: str = "value") -> DataFrame:
    v = F.col(column)
    return rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(v < 0).alias("negative_values"),
        F.count_if(v == 0).alias("zero_values"),
    ).select("*", surplus_rows(rows).scalar().alias("duplicate_records"))
