import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from cellstar.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", " ", "Hello, World's don't I'LL we'Ve", "<|startoftext|>Hi<|endoftext|> <|startoftext", "ΣΑΣ ΟΔΟΣ. İstanbul ß ẞ",
    "e\u0301 \u0301e ﬁ ½ ² Ⅷ ١٢٣ 日本語 русский 😀👍🏽", "a\x1cb\x1db \x85c\xa0d\u2003e\u180ef\u200bg", "1234567 12.5%", "\x00\x01\x7f",
    "x" * 300 + " " + "ab" * 400, "!?" * 200, "''s's", "\ufeffbom", "A\u030a\u0323 \u1100\u1161\u11a8", "<|endoftext|><|endoftext|>",
]


def test_every_text_as_the_library_does(spark):
    known = Tokenizer.from_file(PATH)
    known.no_padding()
    known.no_truncation()
    pick = random.Random(3)
    chars = "abcdefghijklmnop'éèßÉ0123 \n\t.,!-<|>Ω"
    texts = ODD + ["".join(pick.choices(chars, k=pick.randint(1, 400))) for _ in range(300)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, None, None), (3, texts[2], "repeated")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.id, r.ids_sha256): r for r in bpe.encode(docs, PATH).collect()}
    plain = {r.id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    for i, text, _ in rows:
        ids = known.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = known.decode(ids, skip_special_tokens=False)
        found = got[i, digest]
        assert (found.n_tokens, found.ids) == (len(ids), ids)
        assert found.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        if i != 3:
            assert plain[i] == back


def test_scan_and_queue_agree():
    with open(PATH) as file:
        known = bpe.Vocabulary(file.read())
    pick = random.Random(4)
    for _ in range(300):
        parts = [known.ids[pick.choice("abeinorst")] for _ in range(pick.randint(2, 60))]
        assert known._scanned(list(parts)) == known._queued(list(parts))


def test_special_tokens_of_any_spelling():
    with open(PATH) as file:
        content = json.load(file)
    content["added_tokens"].append(content["added_tokens"][0] | {"id": 49408, "content": "[SEP]"})
    content = json.dumps(content)
    ours, theirs = bpe.Vocabulary(content), Tokenizer.from_str(content)
    for text in ("a[SEP]b", "[SEP]", "x [SEP", "<|endoftext|>[SEP]q"):
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
