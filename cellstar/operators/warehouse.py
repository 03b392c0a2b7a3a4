"""Star schema: dimensions with stable keys, fact key lookup, load checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellstar.functions import blank_to_null, indicator_key, period_start, period_year
from cellstar.operators.checks import metric
from cellstar.operators.dense_ids import BUCKET_DIGITS, with_dense_ids


def _last_id(dimension: DataFrame | None, id_name: str) -> Column | int:
    if dimension is None:
        return 0
    return dimension.agg(F.coalesce(F.max(id_name), F.lit(0))).scalar()


def unknown_indicators(
    names: DataFrame, existing: DataFrame | None = None, category: str | None = None
) -> DataFrame:
    """Key, name and category of indicators whose key is not in ``existing`` yet.

    Names that differ only in case, or in space against underscore, share a key and so
    a row; the smallest name is kept. Blank names are ignored.
    """
    name = blank_to_null(F.col("indicator"))
    found = (
        names.select(
            name.alias("indicator_name"),
            (F.col(category) if category else F.lit(None).cast("string")).alias("category"),
        )
        .where(F.col("indicator_name").isNotNull())
        .withColumn("indicator_key", indicator_key(F.col("indicator_name")))
        .groupBy("indicator_key")
        .agg(F.min("indicator_name").alias("indicator_name"), F.min("category").alias("category"))
    )
    if existing is None:
        return found
    return found.join(existing.select("indicator_key"), "indicator_key", "left_anti")


def numbered_indicators(unknown: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Dimension rows with ids that follow those of ``existing``."""
    rows = with_dense_ids(unknown, "indicator_key", "indicator_id", _last_id(existing, "indicator_id"))
    return rows.select("indicator_id", "indicator_key", "indicator_name", "category")


def new_indicators(
    names: DataFrame, existing: DataFrame | None = None, category: str | None = None
) -> DataFrame:
    return numbered_indicators(unknown_indicators(names, existing, category), existing)


def unknown_dates(labels: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Period labels not in ``existing`` yet."""
    found = (
        labels.select(blank_to_null(F.col("year_label")).alias("period_label"))
        .where(F.col("period_label").isNotNull())
        .distinct()
    )
    if existing is None:
        return found
    return found.join(existing.select("period_label"), "period_label", "left_anti")


def numbered_dates(unknown: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Dimension rows; a label that cannot be read keeps NULLs."""
    label = F.col("period_label")
    rows = with_dense_ids(unknown, "period_label", "date_id", _last_id(existing, "date_id"))
    return rows.select(
        "date_id", period_year(label).alias("year"), "period_label", period_start(label).alias("date_value")
    )


def new_dates(labels: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return numbered_dates(unknown_dates(labels, existing), existing)


def with_fact_keys(
    long: DataFrame, indicators: DataFrame, dates: DataFrame, locations: DataFrame | None = None
) -> DataFrame:
    """Look up the dimension keys of measurements; what is not found stays NULL.

    The measurements are never on the broadcast side. Dimensions are shipped only when
    Spark's own size estimate allows it; beyond that the join shuffles, and adaptive
    execution splits the partitions of keys that own many measurements.
    """
    keyed = long.withColumn("indicator_key", indicator_key(blank_to_null(F.col("indicator")))).withColumn(
        "period_label", blank_to_null(F.col("year_label"))
    )
    found = keyed.join(indicators.select("indicator_key", "indicator_id"), "indicator_key", "left").join(
        dates.select("period_label", "date_id"), "period_label", "left"
    )
    if locations is not None and "location" in long.columns:
        place = locations.select(F.col("location_name").alias("location"), "location_id")
        return found.join(place, "location", "left")
    return found.withColumn("location_id", F.lit(None).cast("bigint"))


def sheet_offsets(long: DataFrame) -> DataFrame:
    """``source_file, sheet, width, offset``: where each sheet's rectangle of cells begins.

    Sheets are laid end to end in the order of their hash bucket and name, so the same sheets always
    get the same places. The windows see a bucket's sheets, and 4096 buckets.
    """
    extents = long.groupBy("source_file", "sheet").agg(
        (F.max("row_idx") + 1).alias("_rows"), (F.max("col_idx") + 1).cast("bigint").alias("width")
    )
    size = F.col("_rows") * F.col("width")
    bucket = F.substring(F.md5(F.concat_ws("/", "source_file", "sheet")), 1, BUCKET_DIGITS)
    sized = extents.withColumn("_size", size).withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sized.groupBy("_bucket").agg(F.sum("_size").alias("_size")).select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("_bucket").orderBy("source_file", "sheet").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    # At most 4096 rows whatever the input, so always small enough to ship.
    return placed.join(F.broadcast(buckets), "_bucket").select(
        "source_file", "sheet", "width", (F.col("_first") + F.col("_inside")).alias("offset")
    )


def with_fact_ids(cells: DataFrame, offsets: DataFrame, last: Column | int = 0) -> DataFrame:
    """Adds ``fact_id``: the cell's place in the rectangle of its sheet, after ``last``.

    It depends on the sheets of the load alone, not on how rows are partitioned.
    """
    last = F.lit(last) if isinstance(last, int) else last
    place = F.col("offset") + F.col("row_idx") * F.col("width") + F.col("col_idx")
    joined = cells.join(offsets, ["source_file", "sheet"])
    return joined.withColumn("fact_id", (last + place + 1).cast("bigint")).drop("offset", "width")


def with_location(facts: DataFrame, locations: DataFrame) -> DataFrame:
    """Attach location attributes; facts without a known location stay."""
    return facts.join(
        locations.select("location_id", "location_name", "district", "region"), "location_id", "left"
    )


def split_non_negative(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) under ``value >= 0``; a NULL value passes."""
    violates = F.coalesce(F.col("value") < 0, F.lit(False))
    return facts.where(~violates), facts.where(violates)


KEY_FIELDS = ["indicator", "year_label", "value"]


def completeness_gate(long: DataFrame, table_name: str = "fact_indicator_values") -> DataFrame:
    """One metric row per key field; none may hold a NULL."""
    fields = [c for c in KEY_FIELDS if c in long.columns]
    counts = long.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in fields]
    )
    rows = [
        metric(
            f"warehouse_completeness_{c}",
            "completeness",
            c,
            passed=F.col(f"null_{c}") == 0,
            value=1 - F.coalesce(F.try_divide(F.col(f"null_{c}"), F.col("n")), F.lit(0.0)),
            threshold=1.0,
            rows=F.col("n"),
            failures=F.col(f"null_{c}"),
        )
        for c in fields
    ]
    return _metric_rows(counts, rows, table_name)


def orphan() -> Column:
    """A fact without an indicator or a date."""
    return F.col("indicator_id").isNull() | F.col("date_id").isNull()


def _integrity_row() -> Column:
    clean = F.col("orphans") == 0
    return metric(
        "warehouse_referential_integrity",
        "consistency",
        None,
        passed=clean,
        value=clean.cast("double"),
        threshold=1.0,
        failures=F.col("orphans"),
        details=F.to_json(F.struct(F.col("orphans").alias("orphan_records"))),
    )


def _volume_row() -> Column:
    counts = F.struct(
        F.col("facts").alias("fact_records"), F.col("indicators"), F.col("periods").alias("time_periods")
    )
    return metric(
        "warehouse_fact_count",
        "consistency",
        None,
        passed=F.col("facts") > 0,
        value=F.col("facts").cast("double"),
        threshold=1.0,
        details=F.to_json(counts),
    )


def _with_dimension_sizes(counts: DataFrame, indicators: DataFrame, dates: DataFrame) -> DataFrame:
    return counts.select(
        "*",
        indicators.agg(F.count(F.lit(1))).scalar().alias("indicators"),
        dates.agg(F.count(F.lit(1))).scalar().alias("periods"),
    )


def referential_integrity(facts: DataFrame, table_name: str = "fact_indicator_values") -> DataFrame:
    """Metric row: no fact is an orphan."""
    counts = facts.agg(F.count_if(orphan()).alias("orphans"))
    return _metric_rows(counts, [_integrity_row()], table_name)


def load_volume(
    facts: DataFrame, indicators: DataFrame, dates: DataFrame, table_name: str = "fact_indicator_values"
) -> DataFrame:
    """Metric row: the warehouse holds at least one fact."""
    counts = facts.agg(F.count(F.lit(1)).alias("facts"))
    return _metric_rows(_with_dimension_sizes(counts, indicators, dates), [_volume_row()], table_name)


def committed_checks(
    loads: DataFrame, indicators: DataFrame, dates: DataFrame, table_name: str = "fact_indicator_values"
) -> DataFrame:
    """Both checks from the counts kept per committed file, without reading a fact."""
    counts = loads.agg(
        F.coalesce(F.sum("fact_count"), F.lit(0)).cast("bigint").alias("facts"),
        F.coalesce(F.sum("orphan_count"), F.lit(0)).cast("bigint").alias("orphans"),
    )
    rows = [_integrity_row(), _volume_row()]
    return _metric_rows(_with_dimension_sizes(counts, indicators, dates), rows, table_name)


def _metric_rows(counts: DataFrame, rows: list[Column], table_name: str) -> DataFrame:
    return counts.select(F.inline(F.array(*rows))).withColumn("table_name", F.lit(table_name))
