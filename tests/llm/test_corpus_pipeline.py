import hashlib
from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline
from cellstar.llm import language, mixing, pii
from cellstar.llm.queries import tokenizer_path
from tests.llm.test_simhash import brute_components, brute_print


def staged_rows(spark, folder, docs):
    """What each stage returns, written and read back."""
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, "")
        docs.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_each_stage_beside_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(-1, None, "en", "src0", 0), (-2, "12 34", "en", None, 5), (-3, "", None, None, None), (3, "The same id twice", "en", "a", 1)]
    docs = docs.unionAll(spark.createDataFrame(extra, docs.schema)).unionAll(docs.where("doc_id < 5"))
    known, kept, clean, mixed, tokens = staged_rows(spark, tmp_path, docs)
    for stage in (known, kept, clean, mixed):
        assert stage.columns == docs.columns

    model = language.train(docs.where(~language.held_out(docs.doc_id)))
    rows = docs.collect()
    good = Counter(r for r in rows if model.predict(r.text)[0] != "und" and model.predict(r.text)[1] >= 0.5)
    assert Counter(known.collect()) == good and 195 <= sum(good.values()) <= len(rows) - 3

    rows = sorted(known.collect(), key=lambda r: r.doc_id)
    low = brute_components([brute_print(r.text) for r in rows], 2)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for i, r in enumerate(rows) if low[i] == i)

    field = pii.train(kept)
    for before, after in zip(*(sorted(d.collect(), key=lambda r: (r.doc_id, r.source)) for d in (kept, clean)), strict=True):
        spans = pii.base_spans(before.text)
        text = pii.masked(before.text, spans + field.added(before.text, spans))
        assert (after.text, after.n_chars) == (text, len(text))

    taken = Counter()
    for r in mixing.mix(clean, cut=False).collect():
        taken[r.doc_id] += len(r.mixed.draws)
    assert Counter(r.doc_id for r in mixed.collect()) == +taken and max(n for i, n in taken.items() if i != 3) <= 2

    library = Tokenizer.from_file(tokenizer_path())
    texts = {(r.doc_id, r.text) for r in mixed.collect()}
    found = {(r.doc_id, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in tokens.collect()}
    for doc_id, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (doc_id, digest, back, tuple(ids)) in found
    assert len(found) == len(texts) and tokens.count() == mixed.count()


def test_empty_table_and_clashing_names(spark, tmp_path):
    names = "doc_id long, text string, lang string, source string, n_chars long, fp string, `_x` string, pass int, mixed int, ids int"
    for stage in staged_rows(spark, f"{tmp_path}/none", spark.createDataFrame([], names)):
        assert stage.count() == 0
    rows = [(i, f"the cat and dog number {i} " * i, "en", "s", 1, "f", "x", 7, 8, 9) for i in range(30)]
    *_, mixed, tokens = staged_rows(spark, f"{tmp_path}/some", spark.createDataFrame(rows, names))
    assert mixed.columns[-5:] == ["fp", "_x", "pass", "mixed", "ids"] and tokens.count() == mixed.count() > 10
    assert {tuple(r)[-5:] for r in mixed.collect()} == {("f", "x", 7, 8, 9)}
