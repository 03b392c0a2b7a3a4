"""Explicit schemas of every stored table."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_TS = T.TimestampType()
VALUE = T.DecimalType(38, 6)

# One record per sheet row; a missing cell is NULL. row_idx orders the rows of a
# sheet, is 0 for its first row and dense over at least the first ten rows.
GRID = _schema(
    ("source_file", _S),
    ("sheet", _S),
    ("row_idx", _L),
    ("cells", T.ArrayType(_S, True)),
)

# One record per non-empty value cell. ``text`` is kept only where it is no number.
LONG = _schema(
    ("source_file", _S),
    ("sheet", _S),
    ("row_idx", _L),
    ("col_idx", _I),
    ("indicator", _S),
    ("year_label", _S),
    ("period_label", _S),
    ("value", _D),
    ("text", _S),
)

DIM_DATE = _schema(("date_id", _L), ("year", _I), ("period_label", _S), ("date_value", T.DateType()))
DIM_INDICATOR = _schema(
    ("indicator_id", _L), ("indicator_key", _S), ("indicator_name", _S), ("category", _S)
)
DIM_LOCATION = _schema(("location_id", _L), ("location_name", _S), ("district", _S), ("region", _S))
FACT = _schema(
    ("fact_id", _L),
    ("indicator_id", _L),
    ("date_id", _L),
    ("location_id", _L),
    ("value", VALUE),
    ("units", _S),
    ("notes", _S),
    ("source_file", _S),
    ("load_id", _S),
)
# Measures of a load by file, indicator and date: merged on read, so summaries never reread the facts.
FACT_SUMS = _schema(
    ("source_file", _S),
    ("indicator_id", _L),
    ("date_id", _L),
    ("n", _L),
    ("n_values", _L),
    ("total", VALUE),
    ("low", VALUE),
    ("high", VALUE),
    ("squares", _D),
    ("last_fact_id", _L),
    ("load_id", _S),
)
# One row per committed load: writing it is what makes the load visible.
LOADS = _schema(("load_id", _S), ("committed_at", _TS))
# Which earlier load of a file a load replaces, once it is committed itself.
SUPERSEDED = _schema(("source_file", _S), ("load_id", _S), ("by_load_id", _S))
# One row per (source file, load) with the counts of that load.
FILE_LOADS = _schema(
    ("source_file", _S),
    ("file_hash", _S),
    ("load_id", _S),
    ("fact_count", _L),
    ("orphan_count", _L),
    ("max_fact_id", _L),
    ("loaded_at", _TS),
)

# Append-only log: one 'start' and at least one 'complete' event per run.
RUN_EVENTS = _schema(
    ("run_id", _S),
    ("event", _S),
    ("event_ts", _TS),
    ("pipeline_name", _S),
    ("pipeline_stage", _S),
    ("source_file", _S),
    ("status", _S),
    ("records_input", _L),
    ("records_processed", _L),
    ("records_loaded", _L),
    ("records_rejected", _L),
    ("error_message", _S),
    ("error_details", _S),
    ("metadata", _S),
)
QUALITY_METRICS = _schema(
    ("run_id", _S),
    ("check_name", _S),
    ("check_category", _S),
    ("table_name", _S),
    ("column_name", _S),
    ("passed", _B),
    ("metric_value", _D),
    ("threshold_value", _D),
    ("row_count", _L),
    ("failure_count", _L),
    ("details", _S),
    ("checked_at", _TS),
)
FIELD_LINEAGE = _schema(
    ("run_id", _S),
    ("target_schema", _S),
    ("target_table", _S),
    ("target_column", _S),
    ("source_file", _S),
    ("source_sheet", _S),
    ("source_column", _S),
    ("transformation_logic", _S),
    ("transformation_type", _S),
    ("recorded_at", _TS),
)
SOURCE_FILES = _schema(
    ("file_path", _S),
    ("file_name", _S),
    ("file_hash", _S),
    ("file_size_bytes", _L),
    ("sheet_count", _L),
    ("row_count", _L),
    ("column_count", _L),
    ("first_seen", _TS),
    ("last_processed", _TS),
    ("processing_count", _L),
    ("schema_fingerprint", _S),
    ("status", _S),
)
QUALITY_RULES = _schema(
    ("rule_name", _S),
    ("rule_category", _S),
    ("table_name", _S),
    ("column_name", _S),
    ("rule_type", _S),
    ("rule_config", _S),
    ("is_active", _B),
    ("severity", _S),
)
