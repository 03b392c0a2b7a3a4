import random

from cellstar.llm import substrings

SCHEMA = "doc_id long, text string, _id string, n_removed string"


def brute(rows, least):
    """Every run of sentences that is minimal from its start or to its end, looked up by its words."""
    docs = sorted({(r[0] is None, r[0], r[1]) for r in rows if r[1] is not None}, key=lambda d: (d[0], d[1] or 0, d[2]))
    seen, out = {}, {}
    occurrences = []
    for at, (_, i, text) in enumerate(docs):
        parts = [text[a:b] for a, b in substrings.sentences(text)]
        words = [p.lower().split() for p in parts]
        size = lambda a, b: sum(map(len, words[a : b + 1]))  # noqa: E731, B023
        for a in range(len(parts)):
            for b in range(a, len(parts)):
                if size(a, b) >= least and (size(a, b - 1) < least or size(a + 1, b) < least):
                    occurrences.append((" ".join(" ".join(w) for w in words[a : b + 1] if w), tuple(map(tuple, words[a : b + 1])), at, a, b))
        out[i, text] = (parts, set())
    for _, key, at, a, b in occurrences:
        if seen.setdefault(key, (at, a)) != (at, a):
            out[docs[at][1], docs[at][2]][1].update(range(a, b + 1))
    return {k: ("".join(p for n, p in enumerate(parts) if n not in cut), len(parts), len(cut)) for k, (parts, cut) in out.items()}


def test_beside_brute_force(spark):
    pick = random.Random(8)
    pool = [" ".join(pick.choices("a b c d e f g h".split(), k=pick.randint(1, 9))) + pick.choice([". ", "! ", "?\n", "\n\n"]) for _ in range(400)]
    passages = [pool[k : k + 6] for k in range(0, 60, 6)]
    rows = []
    for i in range(80):
        own = pick.choices(pool[100:], k=pick.randint(0, 12))
        if pick.random() < 0.7:
            own[2:2] = pick.choice(passages)
        rows.append((i, "".join(own), "x", "y"))
    rows += [(None, "".join(passages[0]), "", ""), (5, "".join(passages[1]), "", ""), rows[7], (200, None, "", ""), (201, "", "", "")]
    rows.append((300, "word " * 100_000, "", ""))
    rows.append((301, "Word  " * 100_000, "", ""))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = substrings.remove_repeats(docs, least=12)
    assert out.columns == ["doc_id", "text", "_id", "n_sentences", "n_removed"]
    want = brute(rows, 12)
    expected = sorted((str(r[0]), *(want[r[0], r[1]] if r[1] is not None else (None, 0, 0))) for r in rows)
    assert sorted((str(r.doc_id), r.text, r.n_sentences, r.n_removed) for r in out.collect()) == expected


def test_every_long_passage_goes_and_other_text_stays(spark):
    pick = random.Random(9)
    sentence = lambda: " ".join(f"w{pick.randrange(10**6)}" for _ in range(pick.randint(1, 60))) + ". "
    rows, own = [], {}
    for n in range(40):
        passage = ""
        while len(passage.split()) <= 50:
            passage += sentence()
        for k in range(2):
            head, tail = sentence(), sentence()
            rows.append((2 * n + k, head + passage + tail))
            own[2 * n + k] = head + (passage if k == 0 else "") + tail
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == own


def test_empty_table(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_short_sentences_quotes_and_passages_cut_in_mid_sentence(spark):
    short = 'The road was wet. "Who is there?" He did not answer her at once. '
    passage = "a1 a2 a3 a4 a5 a6 a7 a8 a9 b1. c1 c2 c3 c4 c5 c6 c7. d1 d2 d3 d4 d5 d6 d7 d8!) e1 e2 e3 e4 e5 e6. f1 f2 f3 f4 f5 f6 f7 f8 f9."
    cut = " ".join(passage.split()[4:-4])
    rows = [
        (1, f"Own one. {short}Own text one. {passage}"), (2, f"Own two. {short}Own text two."),
        (3, f"It begins with {cut} and goes on."), (4, "Thank you. Thank you. All rights reserved."), (5, "Thank you. Thank you. All rights reserved."),
    ]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] == rows[0][1] and texts[2] == "Own two. Own text two."
    assert texts[3] == "It begins with a5 a6 a7 a8 a9 b1. f1 f2 f3 f4 f5 and goes on."
    assert texts[4] == texts[5] == rows[4][1]


def test_long_runs_of_signs_take_linear_time():
    for sign in (".", "?!", ".,", "...»"):
        assert "".join(f[a:b] for f in [sign * 200_000] for a, b in substrings.sentences(f)) == sign * 200_000


def test_as_if_every_run_were_hashed(spark):
    """At the query's own settings: all runs of two or more sentences from 12 words, single ones from 30."""
    pick = random.Random(10)
    sentence = lambda: " ".join(pick.choices("a b c d e f g h i j".split(), k=pick.choice([1, 2, 3, 5, 8, 31]))) + ". "
    pool = [sentence() for _ in range(60)]
    rows = []
    for i in range(60):
        own = pick.choices(pool, k=pick.randint(0, 8))
        at = pick.randint(0, len(pool) - 6)
        rows.append((i, "".join(own + pool[at : at + pick.randint(1, 6)] + [sentence(), "\n\n"])))
    seen, want = {}, {}
    for i, text in rows:
        parts = [text[a:b] for a, b in substrings.sentences(text)]
        words = [p.lower().split() for p in parts]
        full, cut = [k for k, w in enumerate(words) if w], set()
        for x in range(len(full)):
            for y in range(x, len(full)):
                run = full[x : y + 1]
                if sum(len(words[k]) for k in run) >= (12 if y > x else 30):
                    key = tuple(tuple(words[k]) for k in run)
                    if seen.setdefault(key, (i, x)) != (i, x):
                        cut.update(range(run[0], run[-1] + 1))
        want[i] = "".join(p for k, p in enumerate(parts) if k not in cut)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in substrings.remove_repeats(docs).collect()}
    assert got == want and sum(len(t) for t in got.values()) < sum(len(t) for _, t in rows)
    few = substrings.remove_repeats(docs, floor=2).agg({"n_removed": "sum"}).first()[0]
    assert few > substrings.remove_repeats(docs).agg({"n_removed": "sum"}).first()[0]


def test_any_other_columns(spark):
    text = "one two three four five six seven. eight nine ten eleven twelve thirteen. "
    names = ["doc_id", "text", "__cuts", "__r", "__id", "__row", "a.b", "id", "r1", "cuts", "c0", "own0", "n", "gone"]
    docs = spark.createDataFrame([(k, text, *names[2:]) for k in range(2)], ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    out = substrings.remove_repeats(docs)
    assert out.columns == [*names, "n_sentences", "n_removed"]
    rows = sorted(out.collect())
    assert [tuple(r)[2:-2] for r in rows] == [tuple(names[2:])] * 2
    assert [(r.text, r.n_removed) for r in rows] == [(text, 0), ("", 2)]


def test_rows_without_id_keep_their_own_sentences(spark):
    own = [f"first{k} words of some row number{k} here. second{k} sentence of that row number{k} too. " for k in range(300)]
    docs = spark.createDataFrame([(None, t) for t in own], "doc_id long, text string")
    assert sorted(r.text for r in substrings.remove_repeats(docs).collect()) == sorted(own)
    twice = docs.unionAll(spark.createDataFrame([(None, own[0] + own[1])], docs.schema))
    assert sum(r.n_removed for r in substrings.remove_repeats(twice).collect()) == 4


def test_long_runs_of_signs():
    text = "a." + ")" * 100 + " b.," + ")" * 100 + " c" + ".," * 100_000 + " d"
    assert [text[a:b][:1] for a, b in substrings.sentences(text)] == ["a", "b"]
