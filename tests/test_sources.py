import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from cellstar.operators import checks
from cellstar.sources import csv_sheets, files, workbook
from tests.xlsx import write_workbook


def test_workbook_cells(spark, tmp_path):
    write_workbook(
        tmp_path / "a.xlsx",
        {
            "One & two": [["title"], [], ["name", None, "'inline", True], [1, 2.5, 3.0, "=text", "1,200"]],
            "Empty": [],
        },
    )
    grid = workbook.read_workbooks(spark, str(tmp_path)).where("error IS NULL").orderBy("row_idx").collect()
    assert [(r.sheet, r.row_idx, r.cells) for r in grid] == [
        ("One & two", 0, ["title"]),
        ("One & two", 2, ["name", None, "inline", "True"]),
        ("One & two", 3, ["1", "2.5", "3", "text", "1,200"]),
    ]


def test_dates_and_texts_without_value(spark, tmp_path):
    """A date is no number, in any style that shows one; a text that means nothing is no cell."""
    styles = [0, 14, "yyyy\\-mm", '0.0" days"', "[Red]#,##0", "[h]:mm"]
    row = [(42552, 0), (42552, 1), (42552.5, 2), (42552, 3), (7, 4), (0.25, 5)]
    write_workbook(tmp_path / "a.xlsx", {"s": [row, ["N/A", "nan", "x", " "]]}, styles=styles)
    grid = workbook.read_workbooks(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [r.error for r in grid] == [None, None]
    assert grid[0].cells == ["42552", "2016-07-01 00:00:00", "2016-07-01 12:00:00", "42552", "7", "06:00:00"]
    assert grid[1].cells == [None, None, "x", None]


def test_raw_completeness_counts_omitted_rows(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"s": [["a", "b"], *[[] for _ in range(8)], ["c", "d"]]})
    row = checks.raw_completeness(workbook.read_workbooks(spark, str(tmp_path))).first()
    assert (row.row_count, row.column_count, row.metric_value, row.passed) == (10, 2, pytest.approx(0.2), False)


def test_bad_files_and_sheets_do_not_stop_the_others(spark, tmp_path):
    write_workbook(tmp_path / "good.xlsx", {"s": [["x"]]})
    write_workbook(tmp_path / "half.xlsx", {"ok": [["y"]], "cut": [["z"]]}, broken=("cut",))
    (tmp_path / "junk.xlsx").write_bytes(b"not a workbook")
    read = workbook.read_workbooks(spark, str(tmp_path))
    errors = workbook.errors_of(read)
    assert sorted((r.source_file.rsplit("/")[-1], r.sheet) for r in errors.collect()) == [("half.xlsx", "cut"), ("junk.xlsx", None)]
    assert sorted(r.cells[0] for r in workbook.without_errors(read, errors).collect()) == ["x", "y"]


def test_discovery(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.discover(spark, str(tmp_path)).count()
    write_workbook(tmp_path / "a.xlsx", {"s": [["x"]]})
    (tmp_path / "b.txt").write_text("no")
    assert files.discover(spark, str(tmp_path)).count() == 1


def test_change_detection(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "file_path string, file_hash string")
    registry = spark.createDataFrame(
        [("a", "1", 4), ("b", "x", 1), ("d", "9", 2)], "file_path string, file_hash string, processing_count bigint"
    )
    found = {r.file_path: (r.state, r.file_hash, r.processing_count) for r in files.detect_changes(now, registry).collect()}
    assert found == {
        "a": ("unchanged", "1", 5), "b": ("changed", "2", 2), "c": ("new", "3", 1), "d": ("missing", "file_not_found", 2),
    }
    assert sorted(r.file_path for r in files.to_process(now, registry).collect()) == ["b", "c"]
    assert files.to_process(now, registry, force=True).count() == 3


def raw(tmp_path, name, text, encoding="utf-8"):
    (tmp_path / name).write_bytes(text.encode(encoding))


def read(spark, tmp_path):
    rows = csv_sheets.read_raw_csv(spark, str(tmp_path)).where("error IS NULL").orderBy("source_file", "row_idx").collect()
    return [(r.source_file.rsplit("/")[-1], r.row_idx, r.cells) for r in rows]


def test_raw_csv(spark, tmp_path):
    raw(tmp_path, "a.csv", '0,1,2\nTitle,,\n"two\nlines",NA,"say ""hi"""\n,"1,200",n/a\n')
    raw(tmp_path, "b.csv", 'Indicator,2016/17\n\nx,1\n5" pipe,"q"uoted"\n"",2')
    assert read(spark, tmp_path) == [
        ("a.csv", 0, ["Title", None, None]),
        ("a.csv", 1, ["two\nlines", None, 'say "hi"']),
        ("a.csv", 2, [None, "1,200", None]),
        ("b.csv", 0, ["Indicator", "2016/17"]),
        ("b.csv", 1, ["x", "1"]),
        ("b.csv", 2, ['5" pipe', 'quoted"']),
        ("b.csv", 3, [None, "2"]),
    ]


def test_encoding_goes_by_validity(spark, tmp_path):
    raw(tmp_path, "a.csv", "0,1\ncafé,1\n", "latin-1")
    raw(tmp_path, "b.csv", "0,1\ncafé \ufffd,1\n")
    assert [cells[0] for _, _, cells in read(spark, tmp_path)] == ["café", "café \ufffd"]


@pytest.mark.parametrize("width", [300, 16_384])
def test_any_width(spark, tmp_path, width):
    cells = [None if i in (256, 257) else f"c{i}" for i in range(width)]
    raw(tmp_path, "a.csv", ",".join(c or "" for c in cells) + "\n")
    assert read(spark, tmp_path) == [("a.csv", 0, cells)]


def test_a_file_with_an_open_quote_does_not_stop_the_others(spark, tmp_path):
    raw(tmp_path, "a.csv", 'x,"never closed\ny,1\n')
    raw(tmp_path, "b.csv", "x,1\n")
    rows = csv_sheets.read_raw_csv(spark, str(tmp_path))
    assert [(r.source_file.rsplit("/")[-1], r.error) for r in workbook.errors_of(rows).collect()] == [("a.csv", csv_sheets.UNCLOSED)]
    assert read(spark, tmp_path) == [("b.csv", 0, ["x", "1"])]


def test_splits_change_nothing(spark, tmp_path):
    """Against the standard library, with line breaks in quotes at the ends of many splits."""
    source = random.Random(3)

    def cell():
        text = "".join(source.choice('ab",\n 5') for _ in range(source.randint(1, 12)))
        return text if source.random() < 0.5 else f"name {source.randint(0, 99)}"

    rows = [[f"r{i}", *(cell() for _ in range(source.randint(0, 3)))] for i in range(2000)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    raw(tmp_path, "a.csv", text.getvalue())
    raw(tmp_path, "b.csv", "0,1\nsmall,1\n")
    hashes = set()
    for size in ("512", "4096", "128MB"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = read(spark, tmp_path)
            files_ = csv_sheets.line_files(csv_sheets.read_lines(spark, str(tmp_path))).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        hashes.add(tuple(sorted(f.file_hash for f in files_)))
        expected = [[None if c.strip() in csv_sheets.NULL_TEXTS else c for c in row] for row in rows]
        assert [cells for name, _, cells in found if name == "a.csv"] == expected
        assert [i for name, i, _ in found if name == "a.csv"] == list(range(2000))
    assert len(hashes) == 1


def test_clean_csv_columns_go_by_position(spark, tmp_path):
    raw(tmp_path, "a_clean.csv", "Facility,when,amount\n Beds ,2016/17,5.0\n,2017/18,1d\n")
    rows = csv_sheets.read_clean_csv(spark, str(tmp_path)).orderBy("year_label").collect()
    assert [(r.indicator, r.year_label, r.value) for r in rows] == [("Beds", "2016/17", 5.0), (None, "2017/18", None)]


def test_csv_export_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([('quote " and, comma', 1)], "a string, b int")
    csv_sheets.write_csv(rows, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert back.select("a", F.col("b").cast("int")).collect() == rows.collect()
