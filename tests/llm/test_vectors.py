import numpy as np
import pytest

from cellstar.llm import near_vectors, top_products

SCHEMA = "vec_id long, embedding array<double>, label int, node string, vector string"
ODD = [(9001, None), (9002, []), (9003, [0.0] * 8), (9004, [1.0, None] * 4), (9005, [float("nan")] * 8), (9006, [float("inf")] + [1.0] * 7), (9007, [1.0, 2.0])]


def vectors(seed, clusters):
    pick = np.random.default_rng(seed)
    base = pick.normal(size=(120, 8))
    near = [base[i % 10] * pick.uniform(0.1, 9) + pick.normal(size=8) * spread for i in range(clusters) for spread in (0.05, 0.4, 0.6)]
    rows = [(i, list(map(float, v))) for i, v in enumerate([*base, *near])]
    rows += ODD + [rows[3], (7, rows[4][1]), (9100, rows[4][1]), (-40, rows[5][1])]
    return rows


def good(v, zero_counts):
    return v and all(x is not None and np.isfinite(x) for x in v) and (zero_counts or any(v))


@pytest.mark.parametrize("size", [16, 4096])
def test_links_beside_brute_force(spark, size):
    rows = vectors(1, 60)
    n = len(rows)
    low, links = list(range(n)), [0] * n
    pairs = []
    for i in range(n):
        for j in range(n):
            a, b = rows[i][1], rows[j][1]
            if i != j and good(a, False) and good(b, False) and len(a) == len(b):
                if np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9:
                    links[i] += 1
                    pairs.append((i, j))
    for _ in range(n):
        for i, j in pairs:
            low[i] = low[j] = min(low[i], low[j])
    least = {}
    for i in range(n):
        least[low[i]] = min(least.get(low[i], 10**9), rows[i][0])
    want = sorted((rows[i][0], links[i], least[low[i]], rows[i][0] == least[low[i]]) for i in range(n))
    table = spark.createDataFrame([(*r, 1, "", "") for r in rows], SCHEMA).repartition(3)
    got = near_vectors.near_duplicates(table, size=size)
    assert got.columns == ["id", "n_links", "component", "kept"]
    assert sorted(map(tuple, got.collect())) == want and len(pairs) > 100


def test_bounds_never_lose_a_pair():
    pick = np.random.default_rng(2)
    for dim in (3, 64, 1100):
        a = pick.normal(size=(200, dim))
        b = a + pick.normal(size=a.shape) * pick.uniform(0, 0.8, (200, 1))
        a[:, 0] *= 50
        for threshold in (-0.2, 0.0, 0.5, 0.9, 0.999):
            cosine = (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
            i, j = near_vectors.close_pairs(a, b, threshold, False)
            assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(cosine >= threshold)), strict=True))


@pytest.mark.parametrize("bucket, block", [(16, 4), (4096, 1024)])
def test_top_k_beside_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(top_products, "BUCKET", bucket)
    monkeypatch.setattr(top_products, "BLOCK", block)
    rows = [(None, [0.5] * 8), *vectors(3, 70)]
    want = []
    whole = [[int(np.floor(64 * x)) for x in v] if good(v, True) else None for _, v in rows]
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None and vec_id % 20 == 0 and whole[i]:
            scored = [(-int(np.dot(whole[i], whole[j])), r[0] is None, r[0]) for j, r in enumerate(rows) if j != i and whole[j] and len(whole[j]) == len(whole[i])]
            want += [(vec_id, n + 1, r, -s) for n, (s, _, r) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:20])]
    table = spark.createDataFrame([(*r, 1, "", "") for r in rows], SCHEMA).repartition(3)
    got = top_products.top_k(table)
    assert got.columns == ["query_id", "rank", "id", "score"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_coordinate_pruning_is_exact():
    pick = np.random.default_rng(4)
    vectors_ = np.floor(pick.normal(size=(500, 6)) * 64).astype(np.int64)
    queries = np.concatenate([vectors_[:40] * 2, np.floor(pick.normal(size=(40, 6)) * 64).astype(np.int64)])
    scores = queries @ vectors_.T
    least = np.sort(scores, axis=1)[:, -5]
    found = top_products.best_of_bucket(queries, np.full(80, -1), least, vectors_, np.arange(500), np.arange(500), 20)
    assert sorted((q, v) for q, v, _ in found) == sorted(zip(*map(np.ndarray.tolist, np.nonzero(scores >= least[:, None])), strict=True))


def test_scores_near_and_beyond_a_long(spark):
    def at(*parts):
        return [float(dict(parts).get(i, 0)) for i in range(64)]

    huge = [(20, at((0, 2**28))), (40, at((63, 2**28))), (60, at((0, 2**26), (1, 2**26))), (80, at((0, -(2**60)), (2, 2**60))), (3, at((5, 1.5)))]
    whole = {i: [min(max(int(np.floor(64 * x)), -(2**63)), 2**63 - 1) for x in v] for i, v in huge}
    want = []
    for q in (20, 40, 60, 80):
        scored = [(-min(max(sum(x * y for x, y in zip(whole[q], whole[i], strict=True)), -(2**63)), 2**63 - 1), i) for i in whole if i != q]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored))]
    table = spark.createDataFrame([(*r, 1, "", "") for r in huge], SCHEMA)
    assert sorted(map(tuple, top_products.top_k(table).collect())) == sorted(want)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_vectors.near_duplicates(empty).collect() == [] == top_products.top_k(empty).collect()
    none = spark.createDataFrame([(20, None, 1, "", "")], SCHEMA)
    assert [tuple(r) for r in near_vectors.near_duplicates(none).collect()] == [(20, 0, 20, True)]
    assert top_products.top_k(none).collect() == []


def test_links_of_tiny_and_huge_vectors(spark):
    base = np.random.default_rng(4).normal(size=(40, 8))
    rows = [(i, list(map(float, v))) for i, v in enumerate(base)]
    rows += [(100 + i, [x * f for x in rows[i][1]]) for i, f in enumerate((1e-200, 1e200, 1e-300, 1e300, 2.0))]
    table = spark.createDataFrame([(*r, 1, "", "") for r in rows], SCHEMA)
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    unit = np.vstack([unit, unit[:5]])
    want = {r[0]: int(n) - 1 for r, n in zip(rows, (unit @ unit.T >= 0.9).sum(1), strict=True)}
    got = {r.id: r for r in near_vectors.near_duplicates(table, size=16).collect()}
    assert {i: r.n_links for i, r in got.items()} == want
    assert all(got[100 + i].component == got[i].component for i in range(5))
