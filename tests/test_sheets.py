import pytest
from pyspark.sql import functions as F

from cellstar.operators import checks, sheets
from cellstar.schemas import GRID


def grid_of(spark, rows, file="f.xlsx", sheet="s"):
    records = [(file, sheet, i, list(cells)) for i, cells in enumerate(rows)]
    return spark.createDataFrame(records, GRID)


def long_of(spark, grid, fallback=False):
    rows = sheets.clean(sheets.unpivot(grid, sheets.layout_of(grid, fallback)))
    return sorted((r.indicator or "", r.year_label, r.period_label, r.value) for r in rows.collect())


def test_title_blank_rows_repeats_and_blanks(spark):
    grid = grid_of(
        spark,
        [
            ["Annual report 1/2"],
            [None, None],
            ["Indicator", "", "2016/17", "2016/17", "2017/18", "Unit"],
            [" Beds ", "x", "1,200", "7", "n.a.", "no"],
            [None, None, None, None, None, None],
            [None, None, "5", None, "6", None],
        ],
    )
    names = sheets.header_names(sheets.header_rows(grid), sheets.column_profile(grid)).orderBy("col_idx").collect()
    assert [r.name for r in names] == ["Indicator", "col_1", "2016/17", "2016/17_1", "2017/18", "Unit"]
    assert [r.base for r in names] == ["Indicator", "col_1", "2016/17", "2016/17", "2017/18", "Unit"]
    assert {r.header_row for r in names} == {2}
    assert long_of(spark, grid) == [
        ("", "2016/17", "2016/17", 5.0),
        ("", "2017/18", "2017/18", 6.0),
        ("Beds", "2016/17", "2016/17", 1200.0),
        ("Beds", "2016/17_1", "2016/17", 7.0),
    ]
    accounting = sheets.accounting(sheets.unpivot(grid, sheets.layout_of(grid))).first()
    assert (accounting.records_input, accounting.records_output, accounting.records_rejected) == (5, 4, 1)


def test_nulls_stay_until_dropped(spark):
    grid = grid_of(spark, [["I", "2016/17", "2017/18"], ["a", "1", None], ["b", None, "2"]])
    long = sheets.unpivot(grid, sheets.layout_of(grid))
    assert long.count() == 4
    assert sheets.drop_empty_values(long).count() == 2


def test_header_needs_two_period_cells_within_ten_rows(spark):
    body = [["text", "x"]] * 9
    inside = grid_of(spark, [*body, ["I", "2016/17", "2017/18"], ["a", "1", "2"]])
    outside = grid_of(spark, [*body, ["more", "x"], ["I", "2016/17", "2017/18"], ["a", "1", "2"]])
    single = grid_of(spark, [["I", "2016/17"], ["a", "1"]])
    assert sheets.header_rows(inside).first().header_row == 9
    assert sheets.header_rows(outside).isEmpty()
    assert sheets.header_rows(single).isEmpty()


def test_fallback_uses_the_first_row(spark):
    grid = grid_of(spark, [["Indicator", "2016", "2017"], ["a", "1", "2"]])
    assert long_of(spark, grid) == []
    assert long_of(spark, grid, fallback=True) == [("a", "2016", "2016", 1.0), ("a", "2017", "2017", 2.0)]


def test_identifier_is_first_filled_name_without_digit(spark):
    grid = grid_of(
        spark,
        [["Notes", "Area 1", "Name", "2016/17", "2017/18"], [None, "north", "Beds", "1", "2"]],
    )
    assert sheets.layout_of(grid).first().id_name == "Name"
    none = grid_of(spark, [["A1", "2016/17", "2017/18"], ["beds", "1", "2"]])
    assert sheets.layout_of(none).first().id_name == "A1"


def test_rows_wider_than_the_header(spark):
    grid = grid_of(spark, [["I", "2016/17", "2017/18"], ["a", "1", "2", "stray", None]])
    names = sheets.header_names(sheets.header_rows(grid), sheets.column_profile(grid))
    assert [r.name for r in names.orderBy("col_idx").collect()][3:] == ["col_3", "col_4"]
    assert long_of(spark, grid) == [("a", "2016/17", "2016/17", 1.0), ("a", "2017/18", "2017/18", 2.0)]


def test_cells_round_trip(spark):
    grid = grid_of(spark, [["I", "2016/17", "2017/18"], ["a", None, "2"]])
    back = sheets.from_cells(sheets.to_cells(grid))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, grid.collect()))


def test_every_sheet_has_its_own_layout(spark):
    one = grid_of(spark, [["I", "2016/17", "2017/18"], ["a", "1", "2"]], sheet="one")
    two = grid_of(spark, [["title"], ["2018/19", "2019/20", "What"], ["3", "4", "b"]], sheet="two")
    none = grid_of(spark, [["nothing here"]], sheet="none")
    grid = one.unionByName(two).unionByName(none)
    assert long_of(spark, grid) == [
        ("a", "2016/17", "2016/17", 1.0),
        ("a", "2017/18", "2017/18", 2.0),
        ("b", "2018/19", "2018/19", 3.0),
        ("b", "2019/20", "2019/20", 4.0),
    ]
    idle = sheets.sheets_without_data(grid, sheets.clean(sheets.unpivot(grid, sheets.layout_of(grid))))
    assert [r.sheet for r in idle.collect()] == ["none"]


def test_large_sheet_is_joined_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sheets, "BLOCK_ROWS", 10)
    rows = [["I", "2016/17", "2017/18"], *[[f"n{i}", str(i), str(-i)] for i in range(1, 95)]]
    grid = grid_of(spark, rows)
    assert len(long_of(spark, grid)) == 188
    keys = sheets.unpivot(grid, sheets.layout_of(grid))._jdf.queryExecution().analyzed().toString()
    assert "_block" in keys


def test_wide_unpivot_keeps_nulls(spark):
    wide = spark.createDataFrame([("a", 1.0, None)], "name string, `2016/17` double, `2017/18` double")
    rows = sheets.unpivot_wide(wide, ["name"], ["2016/17", "2017/18"]).collect()
    assert sorted((r.year_label, r.value) for r in rows) == [("2016/17", 1.0), ("2017/18", None)]


def test_raw_completeness(spark):
    grid = grid_of(spark, [["a", None, None, None], [None, None, None, None], ["b", "c", None, None]])
    row = checks.raw_completeness(grid).first()
    assert (row.row_count, row.column_count, row.metric_value, row.passed) == (3, 4, 0.25, False)


@pytest.mark.parametrize("text, kind", [("1,200", "int"), ("1.5", "decimal"), ("2020-01-31", "date"), ("x", "text"), (None, None)])
def test_cell_types(spark, text, kind):
    rows = spark.createDataFrame([(text,)], "v string")
    assert rows.select(checks.cell_type(F.col("v")).alias("k")).first().k == kind
