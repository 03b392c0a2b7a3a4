import random
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyarrow import fs
from tokenizers import Tokenizer

from cellstar.llm import token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, id string, start long, `a.b` int"


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(3)
    chars = "abcdefghijklmnop'éèßÉ0123 \n\t.,!-<|>Ω\x1c\x85"
    texts = ["".join(pick.choices(chars, k=pick.randint(0, 300))) for _ in range(200)]
    texts += ["<|startoftext|>Hi<|endoftext|> x<|endoftext|>y", "é ́e ﻿bom Ạ̊", "日本語 😀 १२"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts.append(" ".join("".join(pick.choices("abcdefgh", k=6)) for _ in range(60_000)))
    out = [(7 * i % 1009, t, "x", 1, 2) for i, t in enumerate(texts)]
    return out + [(None, "one", "", 0, 0), (None, "two words", "", 0, 0), (None, None, "", 0, 0), (3000, None, "", 0, 0), out[5], out[5], (3001, "", "", 0, 0)]


KNOWN = Tokenizer.from_file(PATH)


def library(text):
    return [*KNOWN.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def files(spark, rows, tmp_path_factory):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    folder = tmp_path_factory.mktemp("tokens")
    return token_files.write(docs, PATH, str(folder), shard_bytes=100_000)


def test_files_hold_every_document_in_order(rows, files):
    assert files.count() > 3
    got = sorted(token_files.read(files, "bigint").collect(), key=lambda r: r.start)
    ids = [r.id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(got) == len(rows)
    want = sorted((str(r[0]), library(r[1])) for r in rows)
    assert sorted((str(r.id), r.ids) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens


def test_plain_tools_decompress_a_file(files):
    for row in files.collect():
        content = open(row.path, "rb").read()
        reader = token_files.Reader(row.path)
        plain = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
        assert len(plain) == 4 * row.ids == 4 * reader.starts[-1]
        assert content[-4:] == struct.pack("<I", 0x8F92EAB1)
        assert row.frames == len(reader.table) - 1 == -(-row.ids // token_files.FRAME_IDS)


def test_only_wanted_frames_are_read(spark, rows, files):
    longest = max((r for r in rows if r[0] is not None), key=lambda r: len(r[1] or ""))
    wanted = spark.createDataFrame([(longest[0], "x"), (3000, "y"), (3000, "z"), (None, ""), (987_654, "")], "doc_id long, path string")
    got = {r.id: r.ids for r in token_files.fetch(files, wanted).collect()}
    assert got == {longest[0]: library(longest[1]), 3000: [1]}
    row = max(files.collect(), key=lambda r: r.frames)
    reader = token_files.Reader(row.path)
    assert row.frames > 1
    list(reader.pieces(0))
    assert reader.frames_read == 1


def test_damage_is_seen(files, tmp_path):
    row = files.first()
    content = bytearray(open(row.path, "rb").read())
    content[int(token_files.Reader(row.path).table[0, 0]) // 2] ^= 255
    (tmp_path / "bad.zst").write_bytes(content)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        for k in range(row.documents):
            list(token_files.Reader(str(tmp_path / "bad.zst")).pieces(k))
    (tmp_path / "cut.zst").write_bytes(content[:-1])
    with pytest.raises(ValueError):
        token_files.Reader(str(tmp_path / "cut.zst"))


def test_uri_folder_and_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert token_files.read(token_files.write(none, PATH, f"file://{tmp_path}/none"), "bigint").collect() == []
    one = token_files.write(spark.createDataFrame([("é", "text")], "doc_id string, text string"), PATH, f"file://{tmp_path}/one", end_id=None)
    assert [(r.id, r.n_tokens) for r in token_files.read(one, "string").collect()] == [("é", 1)]
    assert fs.LocalFileSystem().get_file_info(f"{tmp_path}/one").type == fs.FileType.Directory


def test_other_tokenizers_get_whole_texts():
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        other = token_files.Encoder(file.read())
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    texts = ["Hello  world \n x", "", " a"]
    assert [np.frombuffer(b, "<u4").tolist() for b in other.encode(texts)] == [known.encode(t, add_special_tokens=False).ids for t in texts]
    with open(PATH) as file:
        assert token_files.Encoder(file.read()).by_word
