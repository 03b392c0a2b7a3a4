"""Loosely structured sheets to long measurements.

Input is a *grid*: one record per sheet row with its cells in an array, all sheets of
all files in one DataFrame. Keeping a row together means that its identifier and its
values meet without a shuffle; only the small per-sheet layout is joined in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellstar.functions import blank_to_null, looks_like_period, parse_number, strip
from cellstar.functions.periods import has_digit

SHEET = ["source_file", "sheet"]

# Where a header may be, and how many period cells make one.
HEADER_SCAN_ROWS = 10
MIN_PERIOD_CELLS = 2

# Rows of one sheet that share a join key when the layout is joined to the grid.
BLOCK_ROWS = 100_000


def _block() -> Column:
    return F.floor(F.col("row_idx") / BLOCK_ROWS)


def _has_cells() -> Column:
    return F.exists("cells", lambda c: c.isNotNull())


def to_cells(grid: DataFrame) -> DataFrame:
    """Cell table: one record per non-empty cell."""
    exploded = grid.select(*SHEET, "row_idx", F.posexplode("cells").alias("col_idx", "text"))
    return exploded.where(F.col("text").isNotNull())


def from_cells(cells: DataFrame) -> DataFrame:
    """Grid from a cell table; a group is one sheet row, bounded by the sheet's width."""
    row = F.map_from_entries(F.collect_list(F.struct("col_idx", "text")))
    rows = cells.groupBy(*SHEET, "row_idx").agg(row.alias("m"), F.max("col_idx").alias("last"))
    positions = F.sequence(F.lit(0), F.col("last"))
    padded = F.transform(positions, lambda i: F.try_element_at("m", i))
    return rows.select(*SHEET, "row_idx", padded.alias("cells"))


def header_rows(grid: DataFrame, fallback: bool = False) -> DataFrame:
    """Per sheet ``header_row`` and ``header``: its first row with enough period cells.

    Sheets without one are left out, or use their first row when ``fallback`` is set.
    """
    marks = F.size(F.filter("cells", looks_like_period))
    row = F.struct("row_idx", "cells")
    found = F.min(F.when(marks >= MIN_PERIOD_CELLS, row))
    first = F.min(F.when(F.col("row_idx") == 0, row))
    return (
        grid.where(F.col("row_idx") < HEADER_SCAN_ROWS)
        .groupBy(*SHEET)
        .agg((F.coalesce(found, first) if fallback else found).alias("h"))
        .where(F.col("h").isNotNull())
        .select(*SHEET, F.col("h.row_idx").alias("header_row"), F.col("h.cells").alias("header"))
    )


def column_profile(grid: DataFrame) -> DataFrame:
    """Per sheet column the last row that holds a value and the number of values."""
    filled = F.transform("cells", lambda c: c.isNotNull())
    return (
        grid.select(*SHEET, "row_idx", F.posexplode(filled).alias("col_idx", "filled"))
        .groupBy(*SHEET, "col_idx")
        .agg(
            F.max(F.when(F.col("filled"), F.col("row_idx"))).alias("last_row"),
            F.count_if("filled").alias("n_values"),
        )
    )


def header_names(headers: DataFrame, profile: DataFrame) -> DataFrame:
    """Unique column names: blanks become ``col_<i>``, repeats get ``_1``, ``_2``, …

    ``base`` is the name before a repeat was numbered.
    """
    widths = profile.groupBy(*SHEET).agg((F.max("col_idx") + 1).alias("width"))
    padded = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("width"), F.size("header")) - 1),
        lambda i: F.get("header", i),
    )
    cells = (
        headers.join(widths, SHEET)
        .select(*SHEET, "header_row", F.posexplode(padded).alias("col_idx", "text"))
        .withColumn("text", blank_to_null(F.col("text")))
    )
    seen = F.row_number().over(Window.partitionBy(*SHEET, "text").orderBy("col_idx")) - 1
    numbered = F.when(seen > 0, F.concat("text", F.lit("_"), seen.cast("string"))).otherwise(F.col("text"))
    positional = F.concat(F.lit("col_"), F.col("col_idx").cast("string"))
    return cells.select(
        *SHEET,
        "header_row",
        "col_idx",
        F.coalesce(numbered, positional).alias("name"),
        F.coalesce(F.col("text"), positional).alias("base"),
    )


def filled_columns(names: DataFrame, profile: DataFrame) -> DataFrame:
    """Columns with at least one value below the header."""
    joined = names.join(profile, [*SHEET, "col_idx"])
    return joined.where(F.col("last_row") > F.col("header_row")).drop("last_row", "n_values")


def filled_rows(grid: DataFrame) -> DataFrame:
    """Rows with at least one value."""
    return grid.where(_has_cells())


def sheet_layouts(columns: DataFrame) -> DataFrame:
    """Per sheet its identifier column and its period columns (arrays as wide as the sheet).

    Period names hold a slash and a digit, or digits only; without any, every name
    with a digit counts. The identifier is the first name without a digit, else the
    first column.
    """
    strict = looks_like_period(F.col("name")) | strip(F.col("name")).rlike(r"^\d+$")
    entry = F.struct("col_idx", "name", "base", strict.alias("strict"), has_digit(F.col("name")).alias("digit"))
    layouts = columns.groupBy(*SHEET, "header_row").agg(F.array_sort(F.collect_list(entry)).alias("cols"))
    exact = F.filter("cols", lambda c: c["strict"])
    loose = F.filter("cols", lambda c: c["digit"])
    plain = F.filter("cols", lambda c: ~c["digit"])
    return (
        layouts.withColumn("id", F.coalesce(F.get(plain, F.lit(0)), F.get("cols", F.lit(0))))
        .withColumn("periods", F.when(F.size(exact) > 0, exact).otherwise(loose))
        .select(
            *SHEET,
            "header_row",
            F.col("id.col_idx").alias("id_col"),
            F.col("id.name").alias("id_name"),
            F.transform(
                "periods", lambda c: F.struct(c["col_idx"], c["name"].alias("name"), c["base"].alias("base"))
            ).alias("periods"),
        )
    )


def layout_of(grid: DataFrame, fallback: bool = False) -> DataFrame:
    """Sheet layouts straight from the grid."""
    profile = column_profile(grid)
    names = header_names(header_rows(grid, fallback), profile)
    return sheet_layouts(filled_columns(names, profile))


def period_columns(layouts: DataFrame) -> DataFrame:
    return layouts.select(*SHEET, F.inline("periods")).select(*SHEET, "col_idx", "name", "base")


def unpivot(grid: DataFrame, layouts: DataFrame) -> DataFrame:
    """One record per (data row, period column), empty cells included.

    The layout is joined per block of rows, so a sheet that holds a large share of all
    rows spreads over as many join keys as it has blocks. Spark ships the layouts instead
    where it finds them small enough.
    """
    blocked = grid.withColumn("_block", _block())
    blocks = blocked.select(*SHEET, "_block").distinct()
    data = blocked.join(layouts.join(blocks, SHEET), [*SHEET, "_block"])
    data = data.where((F.col("row_idx") > F.col("header_row")) & _has_cells())
    pairs = F.transform(
        "periods",
        lambda p: F.struct(
            p["col_idx"].alias("col_idx"),
            p["name"].alias("year_label"),
            p["base"].alias("period_label"),
            F.get("cells", p["col_idx"]).alias("text"),
        ),
    )
    return data.select(*SHEET, "row_idx", F.get("cells", F.col("id_col")).alias("indicator"), F.inline(pairs))


def unpivot_wide(rows: DataFrame, id_columns: list[str], period_names: list[str]) -> DataFrame:
    """Same for a DataFrame whose period columns are known by name."""
    return rows.unpivot(id_columns, period_names, "year_label", "value")


def drop_empty_values(long: DataFrame, column: str = "text") -> DataFrame:
    return long.dropna(subset=[column])


def with_clean_values(long: DataFrame) -> DataFrame:
    """Trimmed indicator and parsed ``value``; NULL where the text is no number."""
    return long.withColumn("indicator", blank_to_null(F.col("indicator"))).withColumn(
        "value", parse_number(F.col("text"))
    )


def measured_cells(long: DataFrame) -> DataFrame:
    """Non-empty cells; those that are no number keep their text and have no value."""
    parsed = with_clean_values(drop_empty_values(long))
    return parsed.withColumn("text", F.when(F.col("value").isNull(), F.col("text")))


def clean(long: DataFrame) -> DataFrame:
    """Measurements whose value could be read."""
    return with_clean_values(drop_empty_values(long)).where(F.col("value").isNotNull()).drop("text")


def rejected(long: DataFrame) -> DataFrame:
    """Non-empty cells whose value could not be read."""
    return with_clean_values(drop_empty_values(long)).where(F.col("value").isNull()).drop("value")


def accounting(long: DataFrame) -> DataFrame:
    """Per sheet the non-empty cells, those that became measurements, those rejected."""
    return (
        with_clean_values(long)
        .groupBy(*SHEET)
        .agg(
            F.count("text").alias("records_input"),
            F.count("value").alias("records_output"),
            (F.count("text") - F.count("value")).alias("records_rejected"),
        )
    )


def sheets_without_data(grid: DataFrame, cleaned: DataFrame) -> DataFrame:
    sheets = grid.select(*SHEET).distinct()
    return sheets.join(cleaned.select(*SHEET).distinct(), SHEET, "left_anti")
