"""Whole-table validation: standard checks, domain checks and declarative rules."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.operators import checks as C
from cellstar.operators.repeats import repeat_profile
from cellstar.schemas import QUALITY_RULES
from cellstar.sources.store import local_rows


def standard_checks(rows: DataFrame, critical: list[str] | None = None) -> list[C.Check]:
    keys = C.key_columns(rows)
    repeats = repeat_profile(rows, keys) if keys else None
    return [
        C.completeness(critical or rows.columns),
        C.validity(rows),
        C.consistency(rows, repeats),
        C.key_uniqueness(rows, keys, repeats),
        C.data_types(rows),
    ]


def domain_checks(rows: DataFrame) -> list[C.Check]:
    found = []
    if "indicator" in rows.columns:
        found.append(C.name_validity())
    if "year_label" in rows.columns:
        found.append(C.year_range())
    return found


CRITICAL = ["indicator", "year_label", "value"]


def validate(rows: DataFrame, critical: list[str] | None = None) -> DataFrame:
    """Result per standard check."""
    return C.results(rows, standard_checks(rows, critical))


def validate_metrics(rows: DataFrame, table_name: str, critical: list[str] | None = None) -> DataFrame:
    """Metric rows of the standard checks."""
    return C.metric_rows(rows, table_name, standard_checks(rows, critical))


def validate_domain(rows: DataFrame) -> DataFrame:
    """Result per standard check and per domain check, ``domain`` telling them apart."""
    standard = standard_checks(rows, [c for c in CRITICAL if c in rows.columns])
    domain = domain_checks(rows)
    names = [c.name for c in domain]
    return C.results(rows, [*standard, *domain]).withColumn("domain", F.col("check").isin(names))


def domain_metrics(rows: DataFrame, table_name: str) -> DataFrame:
    critical = [c for c in CRITICAL if c in rows.columns]
    return C.metric_rows(rows, table_name, [*standard_checks(rows, critical), *domain_checks(rows)])


def summarise(results: DataFrame, *by: str) -> DataFrame:
    """Checks run, passed, failed, overall score (0-100) and whether all passed."""
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        (F.avg("score") * 100).alias("overall_score"),
        F.bool_and("passed").alias("all_passed"),
    )


def summarise_domain(results: DataFrame) -> DataFrame:
    """Summary of the standard checks; ``all_passed_domain`` takes the domain checks in."""
    standard = ~F.col("domain")
    return results.agg(
        F.count_if(standard).alias("checks_run"),
        F.count_if(standard & F.col("passed")).alias("checks_passed"),
        F.count_if(standard & ~F.col("passed")).alias("checks_failed"),
        (F.avg(F.when(standard, F.col("score"))) * 100).alias("overall_score"),
        F.bool_and(F.col("passed") | F.col("domain")).alias("all_passed"),
        F.bool_and("passed").alias("all_passed_domain"),
    )


# The rules a new installation starts with.
SEED_RULES = [
    (
        "completeness_indicator", "completeness", "fact_indicator_values", None, "threshold",
        '{"column": "indicator_id", "threshold": 0.99, "check": "not_null"}', True, "critical",
    ),
    (
        "completeness_value", "completeness", "fact_indicator_values", None, "threshold",
        '{"column": "value", "threshold": 0.95, "check": "not_null"}', True, "critical",
    ),
    (
        "validity_value_range", "validity", "fact_indicator_values", None, "range",
        '{"column": "value", "min": 0, "max": 1000000000}', True, "warning",
    ),
    (
        "consistency_foreign_keys", "consistency", "fact_indicator_values", None, "custom_sql",
        '{"check": "foreign_key_integrity"}', True, "critical",
    ),
]
# Named conditions a custom rule may refer to instead of spelling out its SQL.
NAMED_CONDITIONS = {"foreign_key_integrity": "indicator_id IS NOT NULL AND date_id IS NOT NULL"}


def seed_rules(spark: SparkSession) -> DataFrame:
    return rule_rows(spark, SEED_RULES)


def rule_rows(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    return local_rows(spark, QUALITY_RULES, [dict(zip(QUALITY_RULES.names, rule)) for rule in rules])


def _condition(kind: str, config: dict, column: str | None) -> tuple[Column, Column, float]:
    """(rows the rule looks at, rows that satisfy it, share required)."""
    name = config.get("column") or column
    required = float(config.get("threshold", 1.0))
    if kind == "threshold":
        if config.get("check", "not_null") != "not_null":
            raise ValueError(f"unknown threshold check {config['check']!r}")
        return F.lit(True), F.col(name).isNotNull(), required
    if kind == "range":
        low, high = config.get("min"), config.get("max")
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col(name) >= low)
        if high is not None:
            inside = inside & (F.col(name) <= high)
        return F.col(name).isNotNull(), inside, required
    if kind == "pattern":
        return F.col(name).isNotNull(), F.col(name).rlike(config["pattern"]), required
    if kind == "custom_sql":
        sql = config.get("sql") or NAMED_CONDITIONS[config["check"]]
        return F.lit(True), F.expr(sql), required
    raise ValueError(f"unknown rule type {kind!r}")


def evaluate_rules(rows: DataFrame, rules: DataFrame, table_name: str) -> DataFrame:
    """One row per active rule of the table; all rules share one aggregation.

    Rules are configuration, read to the driver like any other setting.
    """
    active = rules.where(F.col("is_active") & (F.col("table_name") == table_name))
    found = active.orderBy("rule_name").collect()
    aggregates, outcomes = [], []
    for i, rule in enumerate(found):
        looked_at, holds, required = _condition(rule.rule_type, json.loads(rule.rule_config), rule.column_name)
        aggregates += [
            F.count_if(looked_at).alias(f"rows_{i}"),
            F.count_if(looked_at & F.coalesce(holds, F.lit(False))).alias(f"good_{i}"),
        ]
        share = F.coalesce(F.try_divide(F.col(f"good_{i}"), F.col(f"rows_{i}")), F.lit(1.0))
        outcomes.append(
            F.struct(
                F.lit(rule.rule_name).alias("rule_name"),
                F.lit(rule.rule_category).alias("rule_category"),
                F.lit(rule.severity).alias("severity"),
                (share >= required).alias("passed"),
                share.alias("metric_value"),
                F.lit(required).alias("threshold_value"),
                F.col(f"rows_{i}").alias("row_count"),
                (F.col(f"rows_{i}") - F.col(f"good_{i}")).alias("failure_count"),
            )
        )
    if not outcomes:
        raise ValueError(f"no active rule for {table_name}")
    return rows.agg(*aggregates).select(F.inline(F.array(*outcomes)))


def structure(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: expected columns present, rows, rows with a NULL in an expected column."""
    rows = []
    for name, (table, expected) in tables.items():
        present = [c for c in expected if c in table.columns]
        nulls = F.count_if(F.exists(F.array(*[F.col(c).isNull() for c in present]), lambda x: x))
        counted = table.agg(
            F.count(F.lit(1)).alias("row_count"), (nulls if present else F.lit(0)).cast("bigint").alias("null_rows")
        )
        complete = len(present) == len(expected)
        rows.append(
            counted.select(
                F.lit(name).alias("table_name"),
                F.lit(complete).alias("columns_present"),
                "row_count",
                "null_rows",
                (F.lit(complete) & (F.col("row_count") > 0)).alias("passed"),
            )
        )
    first, *rest = rows
    for other in rest:
        first = first.unionByName(other)
    return first
