import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cellstar.llm import manifest
from cellstar.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, key long, path string, lo long, `a.b` int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def proofs(leaves):
    """(root, [(left, right), ...] of each leaf) of one tree, run by run."""
    level, ways, members = leaves, [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, held = [], []
        for at in range(0, len(level), 16):
            run = level[at : at + 16]
            for k in range(len(run)):
                for leaf in members[at + k]:
                    ways[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            held.append([leaf for m in members[at : at + 16] for leaf in m])
        level, members = above, held
    return level[0], ways


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        trees.append((own, *proofs([digest(r) for r in own])))
    root, over = proofs([t[1] for t in trees])
    out = []
    for (own, sub, ways), up in zip(trees, over, strict=True):
        for r, way in zip(own, ways, strict=True):
            out.append((r[0], digest(r), sub, root, sha("".join(a + b for a, b in way + up)), way + up))
    return out


def rows_of(n):
    pick = random.Random(5)
    rows = []
    for i in range(n):
        source = pick.choice(["hot"] * 6 + ["é", "z", "", "-", "=", None, f"own{i}"])
        rows.append((i * 3, source, pick.choice(["en", None]), pick.choice([None, i]), pick.choice([None, "", f"Text ÀB {i}", "Same"]), "t", 1, "p", 2, 3))
    rows += [rows[n // 2], rows[n // 2], (None, "hot", None, None, None, "", 0, "", 0, 0), (None, "hot", None, None, "other", "", 0, "", 0, 0)]
    rows.append((10**12, "one", "en", 1, "A long text. " * 200_000, "", 0, "", 0, 0))
    return rows


@pytest.mark.parametrize("n", [1, 17, 700])
def test_beside_brute_force(spark, n):
    rows = rows_of(n)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = manifest.manifest(docs, FIELDS)
    again = manifest.folded(F.col("presented"), F.col("path")).alias("again")
    got = found.select("id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")), "path", again).collect()
    order = lambda r: (str(r[0]), r[1], r[4], r[5])
    want = sorted(brute(rows), key=order)
    got = sorted([(*r[:5], [tuple(s) for s in r.path], r.again) for r in got], key=order)
    assert [g[:6] for g in got] == want
    assert {g[6] for g in got} == {want[0][3]}


def test_tampering_shows(spark, tmp_path):
    rows = [r for r in rows_of(300) if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    leaf = {}
    for r in rows:
        leaf.setdefault(r[0], []).append(r)
    out = QUERIES["op11_manifest"](spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    for o in out:
        text = leaf[o.doc_id][0][4]
        hit = zlib.crc32(str(o.doc_id).encode()) % 5 == 0
        lowered = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        assert o.verified == (not hit or lowered == text)
        assert o.verified == (o.folded_root == o.root)


def test_empty_table_and_single_row(spark):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA), FIELDS).collect() == []
    row = (1, None, None, None, None, "", 0, "", 0, 0)
    only = manifest.manifest(spark.createDataFrame([row], SCHEMA), FIELDS).collect()[0]
    assert only.leaf == only.subroot == only.root == digest(row) and only.path == []
