import random
import zlib

import numpy as np
import pytest

from cellstar.llm import spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        found = [x for x in counts if near(w, x)]
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (form, n, len(found), counts.get(form))
    roots = {}
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        roots[w] = root
    return sorted((w, form, roots[w], n, k, fn) for w, (form, n, k, fn) in out.items())


def test_block_finds_each_edit_by_its_half():
    pick = random.Random(2)
    for _ in range(40):
        chosen = "abcé"[: pick.randint(1, 4)]
        words = list({"".join(pick.choices(chosen, k=pick.randint(1, 9))) for _ in range(pick.randint(1, 100))})
        block, every = spelling.Block(words), np.arange(len(words))
        want = {(i, j) for i in every.tolist() for j in every.tolist() if near(words[i], words[j])}
        first = set(zip(*map(np.ndarray.tolist, block.near(every, False)), strict=True))
        last = set(zip(*map(np.ndarray.tolist, block.near(every, True)), strict=True))
        assert first == {(i, j) for i, j in want if words[j].startswith(words[i][: len(words[i]) // 2])}
        assert last == {(i, j) for i, j in want if words[j].endswith(words[i][len(words[i]) // 2 :])}


@pytest.mark.parametrize("block", [300, 100_000])
def test_groups_beside_brute_force(spark, block):
    """Small blocks split halves that many words share."""
    pick = random.Random(4)
    counts = {"".join(pick.choices("abÿ", k=pick.randint(1, 8))): 3 ** pick.randint(0, 7) for _ in range(250)}
    counts |= {"samehalf" + "".join(pick.choices("xyz", k=5)): 10 ** pick.randint(0, 4) for _ in range(60)}
    if block > 300:
        counts |= {"a" * 900: 1, "a" * 899 + "b": 50, "a" * 901: 500}
    words = spark.createDataFrame([(w, n, "x", 0) for w, n in counts.items()], "word string, n long, half string, `a.b` int")
    got = spelling.group(words, block=block).collect()
    assert sorted(tuple(r) for r in got) == brute(counts)


def test_words_of_texts(spark):
    texts = ["Receive RECEIVE receive, Ünïcode Ünïcode under_score x1receive2", "ÀÉÎõùÿß ÀÉÎõùÿß Éàîõùÿß", None, "", "seven77 receives receives", "longer " * 50_000 + "z" * 5000]
    rows = [(i, t, "word", 9) for i, t in enumerate(texts)] + [(None, texts[0], "", 0), (None, texts[0], "", 0), (4, texts[4], "", 0)]
    rows += [(1000 + i, "deleted deleting letters", "", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, `a.b` int").repartition(3)
    got = {r.word: r.n for r in spelling.words(docs).collect()}
    import re

    want = {}
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            want[word] = want.get(word, 0) + 1
    assert got == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    assert any(near(w, x) for w in got for x in got)


def test_ties_nulls_and_empty_table(spark):
    counts = {"abcdefg": 1, "abcdefh": 10, "abcdefi": 10, "abcdef": 9}
    words = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long")
    got = {r.word: r for r in spelling.group(words).collect()}
    assert got["abcdefg"].form == "abcdefh" and got["abcdefg"].n_near == 3 and got["abcdefh"].form is None
    assert got[None].n_near == 0 and got[None].root is None
    assert spelling.group(spark.createDataFrame([], "word string, n long")).collect() == []
    with pytest.raises(ValueError):
        spelling.group(words, ratio=1)
