"""Raw sheet files (one CSV per sheet) as a grid, and CSV sinks.

Files are read once, as lines, and split like any text. Whether a line begins inside a quoted cell
follows from the lines before it: a line either ends in one state whatever it begins in, or keeps
the state, or turns it. Running windows over a split settle that up to the state the split begins
in, and a window over one row per split supplies the latter, so a file may have any size and width.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from cellstar.functions import blank_to_null, parse_number, strip

# Cell texts that mean "no value" in a raw file.
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# A quote opens a cell only at its start; inside, two stand for one; text after the closing one is plain.
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
_CLOSED = _OPEN + r'"(?:[^",][^,]*+)?+'
_PLAIN = r'[^",][^,]*+'
_ENDS_INSIDE = rf"(?s)\A(?:(?:{_PLAIN}|{_CLOSED})?+,)*+{_OPEN}\z"
_CELL = rf"(?s),((?:{_CLOSED}|{_PLAIN})?+)"
_QUOTED = r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"(.*)\z'

UNCLOSED = "a quoted cell is not closed"
Stage = Callable[[str, DataFrame], DataFrame]


def _unstaged(name: str, rows: DataFrame) -> DataFrame:
    return rows


def _after(rows: DataFrame, before: WindowSpec) -> DataFrame:
    """Adds ``_known, _state`` ahead of each row of ``_settled, _to, _turns`` (see the module's text)."""
    turned = F.coalesce(F.sum(F.col("_turns").cast("int")).over(before), F.lit(0))
    rows = rows.withColumn("_turned", turned)
    last = F.last(F.when(F.col("_settled"), F.struct("_to", "_turned")), ignorenulls=True).over(before)
    rows = rows.withColumn("_last", last)
    odd = (F.col("_turned") - F.coalesce(F.col("_last._turned"), F.lit(0))) % 2 == 1
    state = F.coalesce(F.col("_last._to"), F.lit(False)) != odd
    return rows.withColumn("_known", F.col("_last").isNotNull()).withColumn("_state", state).drop("_turned", "_last")


def read_lines(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``source_file, file_size, line, row, inside, ends_inside, raw``: every line with its place.

    ``row`` numbers the records of a file; the lines of a quoted line break share one. ``inside``
    and ``ends_inside`` tell whether a line begins and ends in a quoted cell. Blank lines between
    records have no row of their own (theirs is that of the record before).
    """
    value = F.col("value")
    from_out, from_in = value.rlike(_ENDS_INSIDE), F.concat(F.lit('"'), value).rlike(_ENDS_INSIDE)
    lines = spark.read.option("pathGlobFilter", pattern).text(folder).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        value.cast("binary").alias("raw"),
        (strip(value) == "").alias("blank"),
        (from_out == from_in).alias("_settled"),
        from_out.alias("_to"),
        (from_out & ~from_in).alias("_turns"),
    )
    split = Window.partitionBy("source_file", "start").orderBy("place")
    upto, before = (split.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    lines = _after(lines, before)
    # Both cases of how the split begins: outside a quoted cell, and inside one.
    cases = {"out": F.col("_state"), "in": F.when(F.col("_known"), F.col("_state")).otherwise(~F.col("_state"))}
    for case, inside in cases.items():
        begins = (~inside & ~F.col("blank")).cast("bigint")
        lines = lines.withColumn(f"_inside_{case}", inside).withColumn(f"_rows_{case}", F.sum(begins).over(upto))
    lines = lines.withColumn("_line", F.row_number().over(split).cast("bigint"))

    ends = lines.groupBy("source_file", "start").agg(
        F.max("_line").alias("_lines"), F.max("_rows_out").alias("_n_out"), F.max("_rows_in").alias("_n_in"),
        F.max_by(F.struct("_known", "_state", "_settled", "_to", "_turns"), "place").alias("_end"),
    )
    end = F.col("_end")
    ends = ends.select(
        "source_file", "start", "_lines", "_n_out", "_n_in",
        (end["_known"] | end["_settled"]).alias("_settled"),
        F.when(end["_settled"], end["_to"]).otherwise(end["_state"] != end["_turns"]).alias("_to"),
    ).withColumn("_turns", ~F.col("_settled") & F.col("_to"))
    # A row per split of a file.
    earlier = Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ends = _after(ends, earlier).withColumn("_rows", F.when(F.col("_state"), F.col("_n_in")).otherwise(F.col("_n_out")))
    opened = ends.select(
        "source_file", "start", F.col("_state").alias("_opened"),
        F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_lines_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
    )

    def by_case(name: str) -> Column:
        return F.when(F.col("_opened"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))

    inside = by_case("_inside")
    return lines.join(opened, ["source_file", "start"]).select(
        "source_file", "file_size",
        (F.col("_lines_before") + F.col("_line") - 1).alias("line"),
        (F.col("_rows_before") + by_case("_rows") - 1).alias("row"),
        inside.alias("inside"),
        F.when(F.col("_settled"), F.col("_to")).otherwise(inside != F.col("_turns")).alias("ends_inside"),
        "raw",
    )


def line_files(lines: DataFrame) -> DataFrame:
    """``source_file, file_size, file_hash, is_utf8, is_closed, has_top`` from the lines, one row per file.

    The hash covers every line with its number and does not depend on how files were split.
    ``has_top`` tells of a line of column numbers above the sheet.
    """
    text = F.col("raw").cast("string")
    marks = [F.bit_xor(F.xxhash64(*order)) for order in (("line", "raw"), ("raw", "line"))]
    first = F.max(F.when((F.col("row") == 0) & ~F.col("inside") & (strip(text) != ""), text))
    cells = F.split("first", ",", -1)
    numbers = F.forall(F.transform(cells, lambda c, i: (c == "") | (c == i.cast("string"))), lambda ok: ok)
    return lines.groupBy("source_file").agg(
        F.max("file_size").alias("file_size"),
        F.md5(F.concat_ws(",", F.count(F.lit(1)), *marks).cast("binary")).alias("file_hash"),
        F.bool_and(F.is_valid_utf8(text)).alias("is_utf8"),
        (~F.max_by("ends_inside", "line")).alias("is_closed"),
        first.alias("first"),
    ).withColumn("has_top", F.coalesce(numbers & (cells[0] != ""), F.lit(False))).drop("first")


def _cells(record: Column) -> Column:
    """Cell texts of a record; null where they mean that there is no value."""

    def text(cell: Column) -> Column:
        inner = F.replace(F.regexp_extract(cell, _QUOTED, 1), F.lit('""'), F.lit('"'))
        whole = F.when(cell.startswith('"'), F.concat(inner, F.regexp_extract(cell, _QUOTED, 2))).otherwise(cell)
        return F.when(~strip(whole).isin(NULL_TEXTS), whole)

    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL), 1), text)


def records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """``source_file, row, cells`` of the closed files among ``files``; a quoted line break is ``\\n``."""
    kept = files.where("is_closed").select("source_file", "is_utf8")
    raw = F.col("raw")
    text = F.when(F.col("is_utf8"), raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1"))
    lines = lines.join(kept, "source_file").select("source_file", "line", "row", "inside", "ends_inside", text.alias("text"))
    broken = F.col("inside") | F.col("ends_inside")
    whole = lines.where(~broken & (strip("text") != "")).select("source_file", "row", "text")
    parts = F.array_sort(F.collect_list(F.struct("line", "text")))
    # As many lines as one record of the sheet has.
    joined = lines.where(broken).groupBy("source_file", "row").agg(F.array_join(parts["text"], "\n").alias("text"))
    return whole.unionByName(joined).select("source_file", "row", _cells(F.col("text")).alias("cells"))


def grid_of(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Grid plus an ``error`` column; a file that cannot be read yields one error row."""
    sheet = F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"\.[^.]*$", "")
    tops = files.select("source_file", F.col("has_top").cast("int").alias("top"))
    index = F.col("row") - F.col("top")
    good = records(lines, files).join(tops, "source_file").where(index >= 0).select(
        "source_file", sheet.alias("sheet"), index.alias("row_idx"), "cells", F.lit(None).cast("string").alias("error")
    )
    bad = files.where(~F.col("is_closed")).select(
        "source_file", F.lit(None).cast("string").alias("sheet"), F.lit(None).cast("bigint").alias("row_idx"),
        F.lit(None).cast("array<string>").alias("cells"), F.lit(UNCLOSED).alias("error"),
    )
    return good.unionByName(bad)


def read_raw_csv(spark: SparkSession, folder: str, pattern: str = "*.csv", stage: Stage = _unstaged) -> DataFrame:
    """Grid of every raw CSV in a folder, with an ``error`` column.

    A file that is not valid UTF-8 is read as Latin-1. ``stage`` may write and read back an
    intermediate result, so that files are read once.
    """
    lines = stage("lines", read_lines(spark, folder, pattern))
    return grid_of(lines, stage("line-files", line_files(lines)))


def read_clean_csv(spark: SparkSession, folder: str, pattern: str = "*.csv", stage: Stage = _unstaged) -> DataFrame:
    """Cleaned files: the first three columns are indicator, year_label and value, whatever their names."""
    lines = stage("lines", read_lines(spark, folder, pattern))
    rows = records(lines, stage("line-files", line_files(lines))).where("row > 0")
    return rows.select(
        "source_file",
        blank_to_null(F.get("cells", F.lit(0))).alias("indicator"),
        F.get("cells", F.lit(1)).alias("year_label"),
        parse_number(F.get("cells", F.lit(2))).alias("value"),
    )


def write_csv(rows: DataFrame, folder: str, partition_by: list[str] | None = None) -> None:
    """CSV export of any result."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').partitionBy(
        *(partition_by or [])
    ).csv(folder)
