import zlib

import numpy as np

from cellstar.llm import language

SCHEMA = "doc_id long, text string, lang string, score string, extra string"


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).collect()
    hidden = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = np.array([r.lang == r.lang_pred for r in hidden])
    score = np.array([r.score for r in hidden])
    assert right.mean() > 0.97 and len(rows) == docs.count()
    assert abs(score.mean() - right.mean()) < 0.05 and ((score >= 0) & (score <= 1)).all()


def test_only_text_and_labels_of_the_rest_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    hidden = "crc32(cast(doc_id as string)) % 3 = 1"
    changed = docs.selectExpr("doc_id", "text", f"if({hidden}, 'xx', lang) lang", "'s' source", "n_chars")
    one, two = (sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(d).collect()) for d in (docs, changed))
    assert one == two


def test_odd_texts(spark):
    rows = [(i, "the cat and the dog " * 3, "en", "x", "y") for i in range(30)]
    rows += [(i, "der hund und die katze " * 3, "de", "x", "y") for i in range(30, 60)]
    rows += [(100, None, "en", "", ""), (101, "", "en", "", ""), (102, "12 !? 3", "de", "", ""), (None, "die katze", None, "", "")]
    rows += [(0, "the cat and the dog " * 3, "en", "x", "y"), (103, "the dog " * 300_000, "en", "", "")]
    found = language.identify(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["doc_id", "text", "lang", "extra", "lang_pred", "score", "held_out"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in found.collect()]
    assert {g[0]: g[1:] for g in got if g[0] in (100, 101, 102)} == dict.fromkeys((100, 101, 102), ("und", 0.0))
    assert {g[0]: g[1] for g in got if g[0] in (None, 103)} == {None: "de", 103: "en"}
    assert len(got) == len(rows)


def test_pieces_of_long_texts_count_like_one(monkeypatch):
    text = "Ünder 12  the brïdge" * 50
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "_PIECE", 7)
    assert (language.gram_counts(text) == whole).all()


def test_nothing_to_learn_from(spark):
    assert language.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    found = language.identify(spark.createDataFrame([(0, "some text", None, "", "")], SCHEMA)).first()
    assert (found.lang_pred, found.score) == ("und", 0.0)
