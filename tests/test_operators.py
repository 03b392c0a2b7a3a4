import random
import statistics

import pytest

from cellstar.operators import repeats
from cellstar.operators.quantiles import exact_quantiles
from cellstar.operators.series import with_previous


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one series."""
    source = random.Random(7)
    rows, row_id = [], 0
    for _ in range(3000):
        series = 1 if source.random() < 0.34 else source.randint(2, 40)
        year = source.choice([2015, 2016, 2017, None])
        row_id += source.randint(1, 50)
        value = None if source.random() < 0.05 else float(source.randint(0, 99))
        rows.append((series, 9999 if year is None else year, year, str(year), row_id, value))
    return rows


SCHEMA = "s int, slot int, year int, label string, id bigint, value double"


def previous(rows, **options):
    slots = rows.select("slot", "year", "label").distinct()
    return with_previous(rows.drop("year", "label"), slots, "s", "slot", ["year", "label"], "id", "value", **options)


def brute_previous(rows):
    expected, last = {}, {}
    ordered = sorted(rows, key=lambda r: (r[0], r[2] is None, r[2] or 0, r[3], r[1], r[4]))
    for series, _, _, _, row_id, value in ordered:
        expected[row_id] = last.get(series)
        last[series] = value
    return expected


@pytest.mark.parametrize("chunk_rows", [1, 40, 1_000_000])
def test_previous_value_across_chunks(spark, skewed, chunk_rows):
    rows = spark.createDataFrame(skewed, SCHEMA).repartition(5)
    found = previous(rows, chunk_rows=chunk_rows)
    assert {r.id: r.prev_value for r in found.collect()} == brute_previous(skewed)


def test_previous_value_without_spread_of_ids(spark):
    rows = spark.createDataFrame([(1, 1, 1, "a", 5, 1.0), (1, 2, 2, "b", 5, 2.0)], SCHEMA)
    found = previous(rows)
    assert sorted((r.value, r.prev_value) for r in found.collect()) == [(1.0, None), (2.0, 1.0)]


@pytest.mark.parametrize("ids", ["outlier", "missing"])
def test_chunks_hold_their_share_of_rows(spark, ids):
    """One id far off, or none at all: no chunk above twice the target, and the same result."""
    n, target = 4000, 200
    far = [(1, 1, 1, "a", i if i else 10**15, float(i % 997)) for i in range(n)]
    none = [(1, 1, 1, "a", None, float(i)) for i in range(n)]
    rows = spark.createDataFrame(far if ids == "outlier" else none, SCHEMA)
    found = previous(rows, chunk_rows=target, keep_chunk=True)
    largest = found.groupBy("_chunk").count().agg({"count": "max"}).first()[0]
    assert largest <= 2 * target
    ordered = sorted(rows.collect(), key=lambda r: (r.id is None, r.id or 0, r.value))
    expected = [None, *(r.value for r in ordered[:-1])]
    got = [(r.id is None, r.id or 0, r.value, r.prev_value) for r in found.collect()]
    assert [g[3] for g in sorted(got, key=lambda g: g[:3])] == expected


def interpolated(values, p):
    ordered = sorted(values)
    rank = p * (len(ordered) - 1)
    low = int(rank)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (rank - low)


@pytest.mark.parametrize("n", [1, 2, 6, 999, 5000])
@pytest.mark.parametrize("accuracy", [100, 100_000])
def test_quantiles_are_exact(spark, n, accuracy):
    """A low accuracy makes the brackets matter at test size."""
    source = random.Random(n)
    values = [0.0 if source.random() < 0.34 else source.lognormvariate(3, 2) for _ in range(n)]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {r.probability: r["quantile"] for r in exact_quantiles(rows, "v", wanted, accuracy).collect()}
    assert found == {p: pytest.approx(interpolated(values, p)) for p in wanted}


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).isEmpty()


def test_quartiles_match_the_standard_library(spark):
    values = [float(x) for x in range(1, 12)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    found = sorted(r["quantile"] for r in exact_quantiles(rows, "v", [0.25, 0.5, 0.75]).collect())
    assert found == statistics.quantiles(values, n=4, method="inclusive")


def test_repeated_rows_with_nulls_and_wide_text(spark):
    text = "long text " * 50
    rows = spark.createDataFrame(
        [(text, 1), (text, 1), (text, 1), (text, 2), (None, None), (None, None), ("", None)], "t string, n int"
    )
    assert repeats.surplus_rows(rows).first().n == 3
    assert repeats.rows_with_repeated_key(rows, ["t"]).first().n == 6
    groups = repeats.repeated_groups(rows, ["t", "n"], "copies")
    assert sorted((r.t or "", r.n or 0, r.copies) for r in groups.collect()) == [("", 0, 2), (text, 1, 3)]


def test_no_repeats_is_zero(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "t string, n int")
    assert repeats.surplus_rows(rows).first().n == 0
    assert repeats.rows_with_repeated_key(rows, ["t"]).first().n == 0


def test_narrow_keys_need_no_digest(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 0.0), (2, -0.0)], "a int, b double")
    assert "sha2" not in repeats.surplus_rows(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert repeats.surplus_rows(rows).first().n == 2
    assert sorted(r.n for r in repeats.repeated_groups(rows, ["a", "b"]).collect()) == [2, 2]


def test_digests_keep_columns_apart(spark):
    rows = spark.createDataFrame(
        [("1:a", "b", 0.0), ("1:a", "b", -0.0), ("1:ab", "", 0.0), ("", "1:ab", 0.0), (None, "-", 0.0), ("-", None, 0.0)],
        "x string, y string, z double",
    )
    assert repeats.surplus_rows(rows).first().n == 1
    assert repeats.rows_with_repeated_key(rows, ["x", "y"]).first().n == 2


def test_nested_rows(spark):
    rows = spark.createDataFrame([(["a, b"],), (["a", "b"],), (["a", "b"],)], "x array<string>")
    assert repeats.surplus_rows(rows).first().n == 1


@pytest.mark.parametrize(
    "schema, records, keys",
    [
        ("k string, v int", [("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1), ("", None)], ["k"]),
        ("k int, v int", [(1, 1), (1, 1), (1, 2), (2, 1), (None, None), (None, None)], ["k"]),
        ("k int, v string", [(1, "x"), (1, "x"), (1, "y"), (2, "x")], ["k"]),
        ("k string, v int", [("a", 1), ("a", 1), ("b", 2)], ["k", "v"]),
        ("k string, v array<int>", [("a", [1]), ("a", [1]), ("a", [2]), ("b", None)], ["k"]),
        ("k string, v int", [], ["k"]),
    ],
)
def test_repeat_profile_agrees_with_single_counts(spark, schema, records, keys):
    rows = spark.createDataFrame(records, schema)
    found = repeats.repeat_profile(rows, keys).first()
    assert found.n_duplicates == repeats.surplus_rows(rows).first().n
    assert found.n_repeated_keys == repeats.rows_with_repeated_key(rows, keys).first().n
