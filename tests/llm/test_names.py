"""Columns of any name beside those an operator reads."""

import pytest

from cellstar.llm import language, mixing, pii, simhash, substrings, urls

NAMES = (
    "a.b", "__print", "__id", "__fp", "__block", "__source", "__end", "__size", "__url", "__hit", "__blocked", "__cuts", "__r", "__row",
    "c0", "c1", "of", "key", "block", "end", "stop", "copy", "shards", "extra", "id", "fp", "print", "n", "gone", "score ",
)


def operators():
    yield "mix", lambda d: mixing.mix(d)
    yield "shards", lambda d: mixing.shard_rows(mixing.mix(d, name="_m"), prefix="_", name="_m")
    yield "language", language.identify
    yield "near copies", simhash.one_of_each
    yield "redact", lambda d: pii.redact(d, pii.train(d))
    yield "repeats", substrings.remove_repeats
    yield "urls", lambda d: urls.judge(d, url_column="text")


@pytest.mark.parametrize("name, apply", list(operators()))
def test_other_columns_keep_their_names_and_values(spark, name, apply):
    rows = [(i, f"the cat and the dog number {i} " * (1 + i % 3), "en", "ab"[i % 2], *[f"{i}:{c}" for c in NAMES]) for i in range(30)]
    rows += [(None, None, None, None, *[f"{None}:{c}" for c in NAMES])]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in NAMES)
    out = apply(spark.createDataFrame(rows, schema))
    assert [c for c in out.columns if c in NAMES] == list(NAMES)
    found = out.select("doc_id", *[f"`{c}`" for c in NAMES]).collect()
    assert found and all(tuple(r)[1:] == tuple(f"{r[0]}:{c}" for c in NAMES) for r in found)
