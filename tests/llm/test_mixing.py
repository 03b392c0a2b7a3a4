import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellstar.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, mixed string"


def documents(spark):
    pick = random.Random(5)
    rows = []
    for i in range(900):
        source = pick.choice(["a", "a", "a", "b", "Z", "é", "", None, "c"])
        words = pick.choice([0, 1, 3, 20, 200])
        rows.append((i, None if pick.random() < 0.05 else " \u00a0x\t" * words, source, "clash", "clash"))
    rows += [(5, "same words", "b", "", "")] * 3 + [(None, "null id here", "b", "", ""), (10**6, "w " * 20_000, "tiny", "", "")]
    return spark.createDataFrame(rows, SCHEMA), rows


def flat(frame):
    return [(r.doc_id, *(r.mixed[c] for c in ("size", "source_size", "target", "taken"))) for r in frame.collect()]


def test_beside_sql(spark):
    docs, rows = documents(spark)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [r[:3] for r in rows])
    got = flat(mixing.mix(docs.repartition(7)))
    assert sorted(got, key=str) == sorted(con.execute(mixing.ORACLE).fetchall(), key=str)
    assert sorted(flat(mixing.mix(docs.repartition(3))), key=str) == sorted(got, key=str)


@pytest.mark.parametrize("cut", [True, False])
def test_shards_hold_each_draw_once(spark, cut):
    docs, rows = documents(spark)
    mixed = mixing.mix(docs, shards=5, cut=cut)
    each = mixed.select("doc_id", "source", "mixed").collect()
    taken, target = {}, {}
    for r in each:
        assert sum(d["words"] for d in r.mixed.draws) == r.mixed.taken <= 2 * r.mixed["size"]
        assert all(0 <= d.shard < 5 for d in r.mixed.draws)
        assert len({d["pass"] for d in r.mixed.draws}) == len(r.mixed.draws)
        taken[r.source] = taken.get(r.source, 0) + r.mixed.taken
        target[r.source] = r.mixed.target
    for source, words in taken.items():
        assert abs(words - target[source]) < (1 if cut else 20_000 if source == "tiny" else 200)
    out = mixing.shard_rows(mixed)
    assert out.count() == sum(len(r.mixed.draws) for r in each)
    assert set(out.columns) == {"doc_id", "text", "source", "size", "pass", "shard", "words"}


def test_blocks_are_permuted_anew_in_each_pass(spark):
    docs = spark.createDataFrame([(i, "a b c", "s", "", "") for i in range(6000)], SCHEMA)
    drawn = {}
    for seed in (1, 2):
        rows = mixing.mix(docs, shards=8, seed=seed).select("doc_id", mixing._block(mixing._key(F.col("doc_id"), F.col("text"))).alias("b"), "mixed.draws")
        places = {(d["pass"], r.b): d.shard for r in rows.collect() for d in r.draws}
        assert places == {(d["pass"], r.b): d.shard for r in rows.collect() for d in r.draws}
        drawn[seed] = places
        near = [places[0, b] == places[0, b + 1] for p, b in places if p == 0 and (0, b + 1) in places]
        assert len(near) > 1500 and np.mean(near) < 0.25  # by chance: an eighth
        both = [places[0, b] == places[1, b] for p, b in places if p == 1]
        assert len(both) > 500 and np.mean(both) < 0.25
        per_shard = [len({k for k, s in places.items() if s == n and k[0] == 0}) for n in range(8)]
        assert sum(per_shard) == len({b for p, b in places if p == 0})
    assert np.mean([drawn[1][k] == drawn[2][k] for k in drawn[1].keys() & drawn[2].keys()]) < 0.25


@pytest.mark.parametrize("cut", [True, False])
def test_the_last_pass_ends_among_copies(spark, cut):
    same = [(None, "one two three", "hot", "", "")] * 900 + [(7, "x y", "b", "", "")] * 500 + [(i, "w " * i, "b", "", "") for i in range(40)]
    docs = spark.createDataFrame(same, SCHEMA).repartition(7)
    mixed = mixing.mix(docs, cut=cut).select("source", "mixed.*").collect()
    assert len(mixed) == len(same)
    for source in ("hot", "b"):
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) < (1 if cut else 40)
        assert all(r.taken <= 2 * r["size"] for r in own)


def test_more_shards_than_blocks(spark):
    docs = spark.createDataFrame([(i, "a b", "s", "", "") for i in range(9000)], SCHEMA)
    shards = [d.shard for r in mixing.mix(docs, shards=8192).select("mixed.draws").collect() for d in r.draws]
    assert max(shards) < 8192 and len(set(shards)) > 5000


def test_tree_is_exact_and_unbiased():
    quotas = [5000, 3, 0, 700, 1]
    total = np.zeros((7, 5))
    for seed in range(200):
        split = mixing.split_quotas(quotas, 7, seed)
        assert (split.sum(0) == quotas).all() and (split >= 0).all()
        assert split.sum(1).max() - split.sum(1).min() <= 1
        total += split
    assert np.allclose(total[:, 0] / 200, 5000 / 7, rtol=0.02)
    assert np.allclose(total[:, 3] / 200, 100, rtol=0.05)


def test_empty_and_wordless(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = flat(mixing.mix(spark.createDataFrame([(1, None, "a", "", ""), (2, " ", None, "", "")], SCHEMA)))
    assert sorted(rows) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
