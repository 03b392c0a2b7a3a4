"""Analytical query book over the star schema.

Facts are reduced to one row per indicator, period or pair before a dimension is
joined, so what meets the dimension (and what is shuffled) is small and an indicator
that owns many facts costs no more than any other. Dimension joins carry no hint:
Spark ships the dimension when its estimated size allows and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellstar.functions import exact_mean, percent, round2
from cellstar.operators.repeats import repeated_groups


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _desc(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]


def _count() -> Column:
    return F.count(F.lit(1))


def reduce_facts(facts: DataFrame, *keys: str) -> DataFrame:
    """Mergeable measures per key: n, n_values, total, low, high."""
    return facts.groupBy(*keys).agg(
        _count().alias("n"),
        F.count("value").alias("n_values"),
        F.sum("value").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Merge reduced rows to coarser keys."""
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("n_values").alias("n_values"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def fact_states(facts: DataFrame, *keys: str) -> DataFrame:
    """Mergeable measures per key, with ``squares``: the sum of squared distances from the key's mean."""
    value = F.col("value").cast("double")
    return facts.groupBy(*keys).agg(
        _count().alias("n"),
        F.count("value").alias("n_values"),
        F.sum("value").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        (F.var_pop(value) * F.count("value")).alias("squares"),
        F.max("fact_id").alias("last_fact_id"),
    )


def merged_states(states: DataFrame, *keys: str, also: Sequence[Column] = ()) -> DataFrame:
    """Merge states to coarser keys, none of them null, with further aggregates ``also``.

    Squares are moved to the common mean, which is joined back: sums of plain squares would lose digits where
    values lie far from zero. States are few, so they are read twice; a key with many can be split by that join.
    """
    whole = merged(states, *keys)
    centre = whole.select(*keys, mean().cast("double").alias("_centre"))
    off = F.try_divide(as_double("total"), F.col("n_values")) - F.col("_centre")
    moved = states.join(centre, list(keys)).groupBy(*keys).agg(
        F.sum(F.col("squares") + F.col("n_values") * off * off).alias("squares"), *also
    )
    return whole.join(moved, list(keys))


def mean() -> Column:
    return exact_mean(F.col("total"), F.col("n_values"))


def as_double(name: str) -> Column:
    return F.col(name).cast("double")


def table_volumes(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [t.agg(_count().alias("record_count")).withColumn("table_name", F.lit(n)) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts).select("table_name", "record_count")


def indicator_sample(indicators: DataFrame, limit: int = 20) -> DataFrame:
    rows = indicators.select("indicator_name", "indicator_key", "category")
    return rows.orderBy(*_asc("indicator_name", "indicator_key")).limit(limit)


def period_listing(dates: DataFrame) -> DataFrame:
    return dates.select("period_label", "year", "date_value").orderBy(*_asc("year", "period_label"))


def completeness_profile(facts: DataFrame) -> DataFrame:
    v = F.col("value")
    return facts.agg(
        _count().alias("total_records"),
        F.count(v).alias("non_null_values"),
        F.count_if(v == 0).alias("zero_values"),
        F.count_if(v < 0).alias("negative_values"),
        round2(exact_mean(F.sum(v), F.count(v))).alias("avg_value"),
        F.min(v).cast("double").alias("min_value"),
        F.max(v).cast("double").alias("max_value"),
    )


def duplicate_records(facts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["indicator_id", "date_id", "value"]
    groups = repeated_groups(facts, keys, "duplicate_count")
    return groups.orderBy(F.col("duplicate_count").desc(), *_asc(*keys))


def orphan_facts(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts whose key is in no dimension row, per dimension; one grouping of the facts serves both."""
    pairs = facts.groupBy("indicator_id", "date_id").agg(_count().alias("n"))

    def orphans(dimension: DataFrame, key: str, issue: str) -> DataFrame:
        per_key = pairs.groupBy(key).agg(F.sum("n").alias("n"))
        unknown = per_key.join(dimension.select(key), key, "left_anti")
        return unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("count")).select(
            F.lit(issue).alias("issue"), "count"
        )

    return orphans(indicators, "indicator_id", "Orphaned facts (no indicator)").unionByName(
        orphans(dates, "date_id", "Orphaned facts (no date)")
    )


def top_indicators(facts: DataFrame, indicators: DataFrame, limit: int = 10) -> DataFrame:
    named = reduce_facts(facts, "indicator_id").join(indicators, "indicator_id")
    return (
        named.select(
            "indicator_name",
            F.col("n").alias("measurement_count"),
            round2(F.col("total")).alias("total_value"),
            round2(mean()).alias("avg_value"),
            as_double("low").alias("min_value"),
            as_double("high").alias("max_value"),
        )
        .orderBy(*_desc("total_value"), *_asc("indicator_name"))
        .limit(limit)
    )


def _spread(facts: DataFrame, indicators: DataFrame) -> DataFrame:
    """Per indicator n, mean, std (sample) and their ratio."""
    per = facts.groupBy("indicator_id").agg(
        _count().alias("n"),
        exact_mean(F.sum("value"), F.count("value")).alias("mean"),
        F.stddev_samp("value").alias("std"),
    )
    return per.withColumn("cv", F.try_divide(F.col("std"), F.col("mean").cast("double"))).join(
        indicators, "indicator_id"
    )


def highest_average(
    facts: DataFrame, indicators: DataFrame, more_than: int = 5, limit: int = 15
) -> DataFrame:
    return (
        _spread(facts, indicators)
        .where(F.col("n") > more_than)
        .select(
            "indicator_name",
            F.col("n").alias("measurements"),
            round2(F.col("mean")).alias("avg_value"),
            round2(F.col("std")).alias("std_dev"),
        )
        .orderBy(*_desc("avg_value"), *_asc("indicator_name"))
        .limit(limit)
    )


def period_trend(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Measures per period; a pair (period, indicator) is one row before it is counted."""
    pairs = reduce_facts(facts, "date_id", "indicator_id")
    per_period = pairs.groupBy("date_id").agg(
        F.sum("n").alias("n"),
        F.sum("n_values").alias("n_values"),
        F.sum("total").alias("total"),
        F.count("indicator_id").alias("unique_indicators"),
    )
    return (
        per_period.join(dates, "date_id")
        .select(
            "period_label",
            "year",
            F.col("n").alias("total_measurements"),
            round2(mean()).alias("avg_value"),
            round2(F.col("total")).alias("total_value"),
            "unique_indicators",
        )
        .orderBy(*_asc("year", "period_label"))
    )


def yoy_growth(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    """Yearly totals per indicator name and their growth over the previous year with data."""
    pairs = reduce_facts(facts, "indicator_id", "date_id")
    named = pairs.join(dates.select("date_id", "year"), "date_id").join(
        indicators.select("indicator_id", "indicator_name"), "indicator_id"
    )
    yearly = merged(named, "indicator_name", "year")
    # One row per year in each window partition.
    by_year = Window.partitionBy("indicator_name").orderBy(F.col("year").asc_nulls_last())
    growth = F.try_divide((F.col("total") - F.col("prev")) * 100, F.col("prev"))
    return (
        yearly.withColumn("prev", F.lag("total").over(by_year))
        .select(
            "indicator_name",
            "year",
            as_double("total").alias("total_value"),
            F.col("n").alias("measurement_count"),
            as_double("prev").alias("prev_year_value"),
            F.when(F.col("prev") > 0, round2(growth)).alias("yoy_growth_percent"),
        )
        .orderBy(*_asc("indicator_name", "year"))
    )


# Upper edges of the value buckets.
BUCKET_EDGES = [0, 10, 50, 100, 500, 1000, 5000, 10000]


def value_bucket(value: Column, edges: list[int] | None = None, strict: bool = False) -> Column:
    """Bucket label such as ``11-50``.

    By default negatives and NULL fall into the open bucket at the end; ``strict``
    names them instead.
    """
    edges = edges or BUCKET_EDGES
    label = F.when(value == edges[0], "Zero")
    if strict:
        label = label.when(value < edges[0], "Negative").when(value.isNull(), "Null")
    for low, high in zip(edges, edges[1:]):
        label = label.when((value > low) & (value <= high), f"{low + 1}-{high}")
    return label.otherwise(f"{edges[-1]}+")


def value_distribution(
    facts: DataFrame, edges: list[int] | None = None, strict: bool = False
) -> DataFrame:
    buckets = facts.groupBy(value_bucket(F.col("value"), edges, strict).alias("value_range")).agg(
        _count().alias("count"), F.min("value").alias("low")
    )
    # The window sees one row per bucket.
    total = F.sum("count").over(Window.partitionBy())
    return (
        buckets.withColumn("percentage", percent(F.col("count"), total))
        .orderBy(*_asc("low"))
        .select("value_range", "count", "percentage")
    )


def zscore_outliers(facts: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Positive values further than ``sigmas`` deviations from the mean of positive values."""
    v = F.col("value").cast("double")
    positive = facts.where(F.col("value") > 0)
    stats = positive.agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    mean_, std = stats.select("mean").scalar(), stats.select("std").scalar()
    score = F.try_divide(v - mean_, std)
    return (
        positive.where(F.abs(score) > sigmas)
        .withColumn("z", score)
        .withColumn("z_score", round2(F.col("z")))
        .orderBy(F.abs("z").desc(), *_asc(*[c for c in facts.columns if c != "value"]))
        .drop("z")
    )


def named_outliers(facts: DataFrame, indicators: DataFrame, dates: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Outliers with the name of their indicator and their period; only they are joined."""
    found = zscore_outliers(facts.select("indicator_id", "date_id", "value"), sigmas)
    named = found.join(indicators.select("indicator_id", "indicator_name"), "indicator_id").join(
        dates.select("date_id", "period_label"), "date_id"
    )
    return named.select("indicator_name", "period_label", F.col("value").cast("double").alias("value"), "z_score").orderBy(
        F.abs("z_score").desc(), *_asc("indicator_name", "period_label", "value")
    )


def _by_variation(facts: DataFrame, indicators: DataFrame, order, at_least: int, limit: int) -> DataFrame:
    return (
        _spread(facts, indicators)
        .where(F.col("n") >= at_least)
        .orderBy(order, *_asc("indicator_name"))
        .limit(limit)
        .select(
            "indicator_name",
            F.col("n").alias("measurements"),
            round2(F.col("mean")).alias("avg_value"),
            round2(F.col("std")).alias("std_dev"),
            round2(F.col("cv") * 100).alias("cv_percent"),
        )
    )


def lowest_cv(facts: DataFrame, indicators: DataFrame, at_least: int = 3, limit: int = 10) -> DataFrame:
    return _by_variation(facts, indicators, F.col("cv").asc_nulls_last(), at_least, limit)


def highest_cv(facts: DataFrame, indicators: DataFrame, at_least: int = 3, limit: int = 10) -> DataFrame:
    return _by_variation(facts, indicators, F.col("cv").desc_nulls_first(), at_least, limit)


def quarter_pattern(facts: DataFrame, dates: DataFrame) -> DataFrame:
    start = F.col("date_value")
    quarter = F.concat(F.lit("Q"), F.quarter(start).cast("string"))
    dated = reduce_facts(facts, "date_id").join(dates.where(start.isNotNull()), "date_id")
    keyed = dated.select(
        "period_label", F.year(start).alias("year"), quarter.alias("quarter"), "n", "n_values", "total", "low", "high"
    )
    return (
        merged(keyed, "period_label", "year", "quarter")
        .select(
            "period_label", "year", "quarter", F.col("n").alias("measurements"), round2(mean()).alias("avg_value")
        )
        .orderBy(*_asc("year", "quarter", "period_label"))
    )


def value_category(value: Column) -> Column:
    return (
        F.when(value == 0, "Zero")
        .when((value > 0) & (value <= 100), "Low")
        .when((value > 100) & (value <= 1000), "Medium")
        .when(value > 1000, "High")
        .otherwise("Unknown")
    )


def summary_report(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    """Every fact with its names, sorted; the fact id keeps a large indicator sortable in parts."""
    return (
        facts.select("fact_id", "indicator_id", "date_id", "value")
        .join(indicators.select("indicator_id", "indicator_name"), "indicator_id")
        .join(dates.select("date_id", "period_label", "year"), "date_id")
        .orderBy(*_asc("indicator_name", "year", "period_label", "fact_id"))
        .select(
            "indicator_name",
            "period_label",
            as_double("value").alias("value"),
            "year",
            value_category(F.col("value")).alias("value_category"),
        )
    )


def average_ranking(facts: DataFrame, indicators: DataFrame, limit: int = 10) -> DataFrame:
    return (
        reduce_facts(facts, "indicator_id")
        .join(indicators, "indicator_id")
        .select("indicator_name", F.col("n").alias("measurement_count"), round2(mean()).alias("avg_value"))
        .orderBy(*_desc("avg_value"), *_asc("indicator_name"))
        .limit(limit)
    )


def random_sample(facts: DataFrame, limit: int = 10, seed: int | None = None) -> DataFrame:
    """``limit`` random facts; with a seed always the same ones, by a hash of seed and key."""
    if seed is None:
        return facts.orderBy(F.rand()).limit(limit)
    return facts.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), "fact_id")), "fact_id").limit(limit)


def distinct_counts(facts: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per column, exact unless ``approximate`` is asked for.

    Each column is reduced on its own: the few keys collapse on the map side and only
    the distinct values travel, which one combined aggregate could not do.
    """
    if approximate:
        return facts.agg(
            F.approx_count_distinct("indicator_id").alias("unique_indicators"),
            F.approx_count_distinct("date_id").alias("unique_dates"),
            F.approx_count_distinct("value").alias("unique_values"),
        )

    def distinct(column: str) -> Column:
        return facts.select(column).distinct().agg(F.count(column)).scalar()

    one = facts.sparkSession.range(1)
    return one.select(
        distinct("indicator_id").alias("unique_indicators"),
        distinct("date_id").alias("unique_dates"),
        distinct("value").alias("unique_values"),
    )


def latest_period(
    facts: DataFrame, indicators: DataFrame, dates: DataFrame, limit: int = 20
) -> DataFrame:
    pairs = facts.groupBy("indicator_id", "date_id").agg(_count().alias("n"))
    return (
        pairs.join(dates, "date_id")
        .groupBy("indicator_id")
        .agg(
            F.max("period_label").alias("latest_period"),
            F.max("year").alias("latest_year"),
            F.sum("n").alias("total_measurements"),
        )
        .join(indicators, "indicator_id")
        .select("indicator_name", "latest_period", "latest_year", "total_measurements")
        .orderBy(*_desc("latest_year", "latest_period"), *_asc("indicator_name"))
        .limit(limit)
    )


def indicator_summary(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    dated = facts.join(dates.select("date_id", "period_label"), "date_id")
    per = dated.groupBy("indicator_id").agg(
        F.count("fact_id").alias("total_measurements"),
        round2(exact_mean(F.sum("value"), F.count("value"))).alias("avg_value"),
        round2(F.stddev_samp("value")).alias("std_dev"),
        F.min("value").cast("double").alias("min_value"),
        F.max("value").cast("double").alias("max_value"),
        F.count_distinct("period_label").alias("periods_covered"),
    )
    named = per.join(indicators.select("indicator_id", "indicator_name", "category"), "indicator_id")
    return named.drop("indicator_id")


def indicator_summary_of(states: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    """The same from states by indicator and date, or by finer keys."""
    dated = states.join(dates.select("date_id", "period_label"), "date_id")
    per = merged_states(dated, "indicator_id", also=[F.count_distinct("period_label").alias("periods_covered")])
    named = per.join(indicators.select("indicator_id", "indicator_name", "category"), "indicator_id")
    return named.select(
        "indicator_name",
        "category",
        F.col("n").alias("total_measurements"),
        round2(mean()).alias("avg_value"),
        round2(F.sqrt(F.try_divide("squares", F.col("n_values") - 1))).alias("std_dev"),
        as_double("low").alias("min_value"),
        as_double("high").alias("max_value"),
        "periods_covered",
    )


def monthly_summary(facts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    return monthly_summary_of(reduce_facts(facts, "indicator_id", "date_id"), indicators, dates)


def monthly_summary_of(states: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    """The same from states by indicator and date, or by finer keys; squares are not needed."""
    dated = states.join(
        dates.where(F.col("date_value").isNotNull()).select(
            "date_id", F.trunc("date_value", "month").alias("month")
        ),
        "date_id",
    )
    # A row per indicator and month before names are looked up.
    named = merged(dated, "month", "indicator_id").join(
        indicators.select("indicator_id", "indicator_name"), "indicator_id"
    )
    return (
        merged(named, "month", "indicator_name")
        .select("month", "indicator_name", round2(mean()).alias("monthly_avg"), F.col("n").alias("measurements"))
        .orderBy(*_asc("month", "indicator_name"))
    )
