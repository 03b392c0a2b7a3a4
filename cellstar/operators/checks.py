"""Data-quality checks that compile into one aggregation per table.

A check names the aggregates it needs and the metric rows it derives from them. All
checks of a table run in a single pass; only repeated rows and repeated keys, which
need a shuffle, are computed apart and joined in as scalars.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellstar.functions import is_numeric_text, strip
from cellstar.functions.numbers import number_text
from cellstar.functions.periods import FISCAL_LABEL
from cellstar.operators.repeats import rows_with_repeated_key, surplus_rows

# Thresholds of the standard checks.
MAX_NULL_SHARE = 0.05
VALUE_RANGE = (0.0, 1e9)
MAX_OUT_OF_RANGE = 0.01
MAX_DUPLICATES = 0.01
MIN_PERIOD_FORMAT = 0.95
MIN_NAME_LENGTH, MAX_NAME_LENGTH, MIN_NAME_SHARE = 5, 500, 0.95
YEAR_RANGE = (2010, 2030)
MIN_YEAR_SHARE = 0.99
MAX_RAW_NULL_SHARE = 0.5
KEY_CANDIDATES = ["indicator", "year_label", "location"]


@dataclass(frozen=True)
class Check:
    name: str
    aggregates: dict[str, Column] = field(default_factory=dict)
    lookups: dict[str, Column] = field(default_factory=dict)  # scalar subqueries
    metrics: list[Column] = field(default_factory=list)
    passed: list[Column] = field(default_factory=list)
    score: Column | None = None  # default: share of ``passed``


def _n(value: Column | None, kind: str) -> Column:
    return (F.lit(None) if value is None else value).cast(kind)


def metric(
    check_name: str,
    category: str,
    column: str | None,
    passed: Column,
    value: Column,
    threshold: float,
    rows: Column | None = None,
    failures: Column | None = None,
    details: Column | None = None,
) -> Column:
    """One metric row as a struct."""
    return F.struct(
        F.lit(check_name).alias("check_name"),
        F.lit(category).alias("check_category"),
        F.lit(column).cast("string").alias("column_name"),
        passed.alias("passed"),
        value.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold_value"),
        _n(rows, "bigint").alias("row_count"),
        _n(failures, "bigint").alias("failure_count"),
        _n(details, "string").alias("details"),
    )


def _share(part: Column, whole: Column, empty: float) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(empty))


def _row_count() -> dict[str, Column]:
    return {"n_rows": F.count(F.lit(1))}


def completeness(columns: list[str], max_null_share: float = MAX_NULL_SHARE) -> Check:
    """Share of NULLs, per column and over all listed columns."""
    nulls = {f"nulls_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(columns)}
    rows = F.col("n_rows")
    per_column = []
    for key, c in zip(nulls, columns):
        share = _share(F.col(key), rows, 0.0)
        per_column.append(
            metric(
                f"completeness_{c}",
                "completeness",
                c,
                passed=share < max_null_share,
                value=1 - share,
                threshold=1 - max_null_share,
                rows=rows,
                failures=F.col(key),
                details=F.to_json(F.struct(share.alias("null_pct"))),
            )
        )
    total = sum((F.col(k) for k in nulls), F.lit(0))
    overall = _share(total, rows * len(columns), 0.0)
    return Check(
        "completeness",
        {**_row_count(), **nulls},
        metrics=per_column,
        passed=[overall < max_null_share],
        score=1 - overall,
    )


def no_negatives(column: str = "value") -> Check:
    v = F.col(column)
    bad = F.col("n_negative")
    return Check(
        "no_negatives",
        {"n_values": F.count(v), "n_negative": F.count_if(v < 0)},
        metrics=[
            metric(
                "validity_no_negatives",
                "validity",
                column,
                passed=bad == 0,
                value=1 - _share(bad, F.col("n_values"), 0.0),
                threshold=1.0,
                rows=F.col("n_values"),
                failures=bad,
            )
        ],
        passed=[bad == 0],
    )


def value_range(
    column: str = "value", low: float = VALUE_RANGE[0], high: float = VALUE_RANGE[1]
) -> Check:
    v = F.col(column)
    bad = F.col("n_out_of_range")
    share = _share(bad, F.col("n_values"), 0.0)
    return Check(
        "value_range",
        {
            "n_values": F.count(v),
            "n_out_of_range": F.count_if((v < low) | (v > high)),
            "min_value": F.min(v).cast("double"),
            "max_value": F.max(v).cast("double"),
        },
        metrics=[
            metric(
                "validity_value_range",
                "validity",
                column,
                passed=share < MAX_OUT_OF_RANGE,
                value=1 - share,
                threshold=1 - MAX_OUT_OF_RANGE,
                rows=F.col("n_values"),
                failures=bad,
                details=F.to_json(
                    F.struct(
                        "min_value",
                        "max_value",
                        F.array(F.lit(low), F.lit(high)).alias("expected_range"),
                    )
                ),
            )
        ],
        passed=[share < MAX_OUT_OF_RANGE],
    )


def no_infinites(column: str = "value") -> Check:
    bad = F.col("n_infinite")
    return Check(
        "no_infinites",
        {
            "n_values": F.count(F.col(column)),
            "n_infinite": F.count_if(F.abs(F.col(column).cast("double")) == float("inf")),
        },
        metrics=[
            metric(
                "validity_no_infinites",
                "validity",
                column,
                passed=bad == 0,
                value=(bad == 0).cast("double"),
                threshold=1.0,
                failures=bad,
            )
        ],
        passed=[bad == 0],
    )


def _is_numeric(rows: DataFrame, column: str) -> bool:
    return column in rows.columns and isinstance(rows.schema[column].dataType, T.NumericType)


def validity(rows: DataFrame, column: str = "value") -> Check:
    """Roll-up of the value checks; a table without numeric values passes."""
    if not _is_numeric(rows, column):
        return Check("validity", _row_count(), passed=[F.lit(True)])
    parts = [no_negatives(column), value_range(column), no_infinites(column)]
    return Check(
        "validity",
        {k: v for p in parts for k, v in p.aggregates.items()},
        # Metric rows exist only when there is a value to look at.
        metrics=[F.when(F.col("n_values") > 0, m) for p in parts for m in p.metrics],
        passed=[p.passed[0] for p in parts],
    )


def duplicate_rows(rows: DataFrame, repeats: DataFrame | None = None) -> Check:
    """Rows beyond the first of each group of equal rows.

    ``repeats`` is a repeat profile of the rows, when one is at hand.
    """
    counted = surplus_rows(rows) if repeats is None else repeats.select("n_duplicates")
    dup = F.col("n_duplicates")
    share = _share(dup, F.col("n_rows"), 0.0)
    return Check(
        "duplicate_rows",
        _row_count(),
        lookups={"n_duplicates": counted.scalar()},
        metrics=[
            metric(
                "consistency_no_duplicates",
                "consistency",
                None,
                passed=share < MAX_DUPLICATES,
                value=1 - share,
                threshold=1 - MAX_DUPLICATES,
                rows=F.col("n_rows"),
                failures=dup,
                details=F.to_json(F.struct(dup.alias("duplicate_count"))),
            )
        ],
        passed=[share < MAX_DUPLICATES],
    )


def period_format(column: str = "year_label") -> Check:
    label = F.col(column).cast("string")
    good = _share(F.col("n_period_ok"), F.col("n_labels"), 1.0)
    return Check(
        "period_format",
        {"n_labels": F.count(label), "n_period_ok": F.count_if(label.rlike(FISCAL_LABEL))},
        metrics=[
            metric(
                "consistency_year_format",
                "consistency",
                column,
                passed=good > MIN_PERIOD_FORMAT,
                value=good,
                threshold=MIN_PERIOD_FORMAT,
                rows=F.col("n_labels"),
                failures=F.col("n_labels") - F.col("n_period_ok"),
            )
        ],
        passed=[good > MIN_PERIOD_FORMAT],
    )


def consistency(rows: DataFrame, repeats: DataFrame | None = None) -> Check:
    parts = [duplicate_rows(rows, repeats)]
    if "year_label" in rows.columns:
        parts.append(period_format())
    return Check(
        "consistency",
        {k: v for p in parts for k, v in p.aggregates.items()},
        {k: v for p in parts for k, v in p.lookups.items()},
        [m for p in parts for m in p.metrics],
        [c for p in parts for c in p.passed],
    )


def key_columns(rows: DataFrame) -> list[str]:
    return [c for c in KEY_CANDIDATES if c in rows.columns]


def key_uniqueness(
    rows: DataFrame, keys: list[str] | None = None, repeats: DataFrame | None = None
) -> Check:
    """All rows of a repeated key count; without key columns the check passes unseen."""
    keys = keys or key_columns(rows)
    if not keys:
        return Check("uniqueness", _row_count(), passed=[F.lit(True)])
    counted = rows_with_repeated_key(rows, keys) if repeats is None else repeats.select("n_repeated_keys")
    bad = F.col("n_repeated_keys")
    share = _share(bad, F.col("n_rows"), 0.0)
    return Check(
        "uniqueness",
        _row_count(),
        lookups={"n_repeated_keys": counted.scalar()},
        metrics=[
            metric(
                "uniqueness_key_constraint",
                "consistency",
                None,
                passed=bad == 0,
                value=1 - share,
                threshold=1.0,
                rows=F.col("n_rows"),
                failures=bad,
                details=F.to_json(
                    F.struct(
                        F.array(*[F.lit(k) for k in keys]).alias("key_columns"),
                        bad.alias("duplicate_count"),
                    )
                ),
            )
        ],
        passed=[bad == 0],
        score=1 - share,
    )


def data_types(rows: DataFrame, column: str = "value") -> Check:
    """The value column is numeric. A typed column cannot hold mixed types."""
    metrics, passed = [], []
    if column in rows.columns:
        numeric = _is_numeric(rows, column)
        passed.append(F.lit(numeric))
        metrics.append(
            metric(
                "type_value_is_numeric",
                "validity",
                column,
                passed=F.lit(numeric),
                value=F.lit(float(numeric)),
                threshold=1.0,
            )
        )
    passed.append(F.lit(True))
    metrics.append(
        metric(
            "type_no_mixed_types",
            "validity",
            None,
            passed=F.lit(True),
            value=F.lit(1.0),
            threshold=1.0,
            details=F.lit('{"mixed_type_columns":[]}'),
        )
    )
    return Check("data_types", _row_count(), metrics=metrics, passed=passed)


def numeric_text(column: str) -> Check:
    """Share of raw cells that read as numbers; all must."""
    text = F.col(column)
    good = _share(F.col("n_numeric"), F.col("n_cells"), 1.0)
    return Check(
        "numeric_text",
        {"n_cells": F.count(text), "n_numeric": F.count_if(is_numeric_text(text))},
        metrics=[
            metric(
                "type_value_is_numeric",
                "validity",
                column,
                passed=F.col("n_numeric") == F.col("n_cells"),
                value=good,
                threshold=1.0,
                rows=F.col("n_cells"),
                failures=F.col("n_cells") - F.col("n_numeric"),
            )
        ],
        passed=[F.col("n_numeric") == F.col("n_cells")],
        score=good,
    )


def cell_type(text: Column) -> Column:
    """Type a raw cell looks like: int, decimal, date or text; NULL for no cell."""
    plain = strip(text)
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(number_text(text).rlike(r"^[+-]?[0-9]+$"), "int")
        .when(is_numeric_text(text), "decimal")
        .when(plain.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$"), "date")
        .otherwise("text")
    )


def mixed_types(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per raw column the number of cells of each type; more than one type is mixed."""
    kinds = ["int", "decimal", "date", "text"]
    counts = rows.agg(
        *[F.count_if(cell_type(F.col(c)) == k).alias(f"{k}_{i}") for i, c in enumerate(columns) for k in kinds]
    )
    per_column = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{k}_{i}").alias(f"n_{k}") for k in kinds])
        for i, c in enumerate(columns)
    ]
    present = sum(((F.col(f"n_{k}") > 0).cast("int") for k in kinds), F.lit(0))
    return (
        counts.select(F.inline(F.array(*per_column)))
        .withColumn("n_types", present)
        .withColumn("passed", F.col("n_types") <= 1)
    )


def name_validity(column: str = "indicator") -> Check:
    """No blank name, and nearly all of a reasonable length."""
    name = F.col(column).cast("string")
    ok = F.col("n_name_length_ok")
    share = _share(ok, F.col("n_names"), 1.0)
    passed = (F.col("n_blank_names") == 0) & (share > MIN_NAME_SHARE)
    return Check(
        "name_validity",
        {
            "n_names": F.count(name),
            "n_blank_names": F.count_if(strip(name) == ""),
            "n_name_length_ok": F.count_if(F.length(name).between(MIN_NAME_LENGTH, MAX_NAME_LENGTH)),
        },
        metrics=[
            metric(
                "health_indicator_names_valid",
                "validity",
                column,
                passed=passed,
                value=share,
                threshold=MIN_NAME_SHARE,
                failures=F.col("n_names") - ok,
            )
        ],
        passed=[passed],
    )


def year_range(column: str = "year_label", low: int = YEAR_RANGE[0], high: int = YEAR_RANGE[1]) -> Check:
    """First four digits of the label within the range; unreadable labels fail."""
    label = F.col(column).cast("string")
    year = F.nullif(F.regexp_extract(label, r"^(\d{4})", 1), F.lit("")).cast("int")
    share = _share(F.col("n_year_ok"), F.col("n_labels"), 1.0)
    return Check(
        "year_range",
        {
            "n_labels": F.count(label),
            "n_year_ok": F.count_if(year.between(low, high)),
            "min_year": F.min(year),
            "max_year": F.max(year),
        },
        metrics=[
            metric(
                "health_year_range_valid",
                "validity",
                column,
                passed=share > MIN_YEAR_SHARE,
                value=share,
                threshold=MIN_YEAR_SHARE,
                rows=F.col("n_labels"),
                failures=F.col("n_labels") - F.col("n_year_ok"),
                details=F.to_json(
                    F.struct(
                        F.array(F.lit(low), F.lit(high)).alias("expected_range"), "min_year", "max_year"
                    )
                ),
            )
        ],
        passed=[share > MIN_YEAR_SHARE],
    )


def measure(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """The one-row aggregate that all given checks read."""
    aggregates = {k: v for c in checks for k, v in c.aggregates.items()}
    lookups = {k: v for c in checks for k, v in c.lookups.items()}
    counts = rows.agg(*[v.alias(k) for k, v in aggregates.items()])
    return counts.select("*", *[v.alias(k) for k, v in lookups.items()])


def metric_rows(rows: DataFrame, table_name: str, checks: list[Check]) -> DataFrame:
    metrics = F.array(*[m for c in checks for m in c.metrics])
    present = F.filter(metrics, lambda m: m.isNotNull())
    return (
        measure(rows, checks).select(F.inline(present)).withColumn("table_name", F.lit(table_name))
    )


def results(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: passed, and a score between 0 and 1."""

    def verdict(check: Check) -> Column:
        outcomes = F.array(*check.passed)
        share = F.size(F.filter(outcomes, lambda ok: ok)) / F.lit(len(check.passed))
        return F.struct(
            F.lit(check.name).alias("check"),
            F.forall(outcomes, lambda ok: ok).alias("passed"),
            (share if check.score is None else check.score).cast("double").alias("score"),
        )

    return measure(rows, checks).select(F.inline(F.array(*[verdict(c) for c in checks])))


def raw_completeness(grid: DataFrame) -> DataFrame:
    """Per sheet the share of filled cells in its rows × columns rectangle, rows that were left out included."""
    width = F.max(F.size("cells"))
    filled = F.sum(F.size(F.filter("cells", lambda c: c.isNotNull())).cast("bigint"))
    sheets = grid.groupBy("source_file", "sheet").agg(
        (F.max("row_idx") + 1).alias("row_count"), width.cast("bigint").alias("column_count"), filled.alias("filled")
    )
    null_share = 1 - F.try_divide(F.col("filled").cast("double"), F.col("row_count") * F.col("column_count"))
    return sheets.where((F.col("row_count") > 0) & (F.col("column_count") > 0)).select(
        "source_file",
        "sheet",
        F.lit("raw_completeness").alias("check_name"),
        (null_share < MAX_RAW_NULL_SHARE).alias("passed"),
        (1 - null_share).alias("metric_value"),
        F.lit(MAX_RAW_NULL_SHARE).alias("threshold_value"),
        "row_count",
        "column_count",
    )
