import random

import numpy as np
import pytest
import xxhash

from cellstar.llm import simhash

SCHEMA = "doc_id bigint, text string, id string, fp string"


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    spans = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    low = list(range(len(prints)))
    moved = True
    while moved:
        moved = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius and low[i] != low[j]:
                    low[i] = low[j] = min(low[i], low[j])
                    moved = True
    return low


def result(rows):
    return sorted((r.id, r.fp & (2**64 - 1), r.component) for r in rows.collect())


def test_documents_beside_brute_force(spark):
    pick = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    texts = [None, "", " \n\t", "One", "one", "TWO words", "É É É É", "a\x0bb\x0cc d e", "é é é é"]
    for _ in range(60):
        own = pick.choices(words, k=pick.randint(3, 80))
        texts += [" ".join(own)] * pick.randint(1, 3)
        own[0] = "changed"
        texts.append("  ".join(own))
    texts.append(" ".join(pick.choices(words, k=60_000)))
    rows = [(i, t, "clash", None) for i, t in enumerate(texts)]
    prints = [brute_print(t) for t in texts]
    low = brute_components(prints, 2)
    got = result(simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert got == [(i, p, c) for i, (p, c) in enumerate(zip(prints, low, strict=True))]


def test_spark_hash_is_the_hash(spark):
    assert spark.sql("select xxhash64('ä b c')").first()[0] % 2**64 == xxhash.xxh64_intdigest("ä b c".encode(), 42)


@pytest.mark.parametrize("bucket", [4, 64])
def test_dense_and_skewed_prints(spark, bucket):
    pick = random.Random(2)
    prints = {0, 1, 3, 7}
    for _ in range(3):
        base = pick.getrandbits(64)
        for _ in range(90):
            prints.add(base ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 5))))
    prints |= {pick.getrandbits(12) for _ in range(60)}
    prints = sorted(prints)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), 2, bucket=bucket)
    low = brute_components(prints, 2)
    label = list(range(len(prints)))
    place = {p: i for i, p in enumerate(signed)}
    pairs = [(place[a], place[b]) for a, b in links.collect()]
    assert all((low[i] == low[j]) for i, j in pairs)
    for _ in prints:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    assert [low.index(x) for x in low] == [label.index(x) for x in label]


def test_allocation_adds_up_and_skips_the_dear_group():
    costs = [[0, 1, 5, 9], [0, 1, 5, 9], [0, 1, 5, 9], [0, 100, 900, 9000]]
    assert simhash.allocate(costs, 2) == [0, 0, 0, -1]


def test_empty_null_ids_and_repeated_rows(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "x y z w", "", ""), (7, "x y z w", "", ""), (7, "x y z w", "", ""), (None, "q", "", "")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.id, r.component) for r in got if r.id) == [(7, 7), (7, 7)]
    assert sorted(str(r.component) for r in got if r.id is None) == ["7", "None"]
