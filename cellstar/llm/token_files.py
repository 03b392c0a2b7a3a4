"""Token ids as binary files: independent zstandard frames, a trailing seek table, a checksum a frame.

Documents are dealt to shards by ranges of their id, and a shard is one file in the public seekable format of zstandard:

* frames of ``FRAME_IDS`` ids each (the last one shorter), little-endian unsigned 32-bit, documents end to
  end; a document lies in the frames that its first and last id fall into;
* a skippable frame with the shard's index: id and number of ids of each document, compressed;
* a skippable frame with the seek table: compressed size, size and checksum (low half of XXH64) of every frame,
  closed by a footer. Plain zstandard tools decompress such a file to its ids.

A reader takes the footer, the table and the index, then only the frames of the documents it wants. Every attempt of a task
writes a file under a name of its own, and a table names the files of the attempts that counted, so that lost
executors leave at most files that nobody reads.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.bpe import SPACE, byte_characters
from cellstar.llm.shared import slices, staged
from cellstar.session import checkpoint_dir

#: Ids of a frame, bytes of text of a shard, and chunks and words a worker keeps encoded.
FRAME_IDS, SHARD_BYTES, KEPT = 1 << 16, 32 << 20, 300_000
#: Fixed values of the seekable format: magic numbers, the descriptor of a table with checksums.
_INDEX_MAGIC, _TABLE_MAGIC, _END_MAGIC, _CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80
_FOOTER = 9
#: Fixed values of tokenizers that never look across white space: their normalizers and pattern.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# White space is the library's, not this module's.
_WORD = regex.compile(_WORDS.replace(r"\s", SPACE))
_CHUNK = regex.compile(f"[^{SPACE}]+")
_ODD = regex.compile(r"[\x1c-\x1f]")


class Encoder:
    """A tokenizer file, loaded by the tokenizers library.

    Where the file's rules cannot look across white space, texts are normalised and cut into words here and the library's model
    encodes each word that a worker does not keep from earlier texts; other files get whole texts.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        file = json.loads(content)
        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self._model = self.library.model
        normal = (file.get("normalizer") or {}).get("normalizers")
        cut = (file.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        added = file.get("added_tokens", [])
        self.by_word = (
            normal == _NORMAL
            and (cut[0].get("pattern"), cut[0].get("behavior"), cut[0].get("invert")) == ({"Regex": _WORDS}, "Removed", True)
            and [c["type"] for c in cut[1:]] == ["ByteLevel"] and not (cut[1]["add_prefix_space"] or cut[1]["use_regex"])
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        )
        self._special = {t["content"]: struct.pack("<I", t["id"]) for t in added}
        names = sorted(map(regex.escape, self._special), key=len, reverse=True)
        self._split = regex.compile("(" + "|".join(names) + ")") if names else None
        self._letters = dict(enumerate(byte_characters()))
        self._chunks: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self._words.get(word)
        if ids is None:
            shown = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self._letters)
            ids = array("I", [t.id for t in self._model.tokenize(shown)]).tobytes()
            if len(word) <= 64:
                self._words[word] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        """Ids of text without special tokens."""
        # Lower-casing is by character, without the final form of sigma.
        text = (text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")).lower()
        chunks, known = _CHUNK.findall(text) if _ODD.search(text) else text.split(), self._chunks
        found = list(map(known.get, chunks))
        if None in found:
            for k, chunk in enumerate(chunks):
                if found[k] is None and (ids := known.get(chunk)) is None:
                    if chunk.isalpha():
                        ids = self._word(chunk)
                    elif chunk[:-1].isalpha() and not chunk[-1].isalnum():
                        ids = self._word(chunk[:-1]) + self._word(chunk[-1])
                    else:
                        ids = b"".join(map(self._word, _WORD.findall(chunk)))
                    if len(chunk) <= 64:
                        known[chunk] = ids
                    found[k] = ids
                elif found[k] is None:
                    found[k] = ids
        return b"".join(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as they are stored."""
        if not self.by_word:
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]
        for kept in (self._chunks, self._words):
            if len(kept) > KEPT:
                kept.clear()
        out = []
        for text in texts:
            if any(s in text for s in self._special):
                out.append(b"".join([self._special.get(p) or self._plain(p) for p in self._split.split(text)]))
            else:
                out.append(self._plain(text))
        return out


_LOADED: dict[str, Encoder] = {}


def _encoder(content: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Encoder(content)
    return _LOADED[key]


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path: of a URI, or of a local path."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class Writer:
    """One file: ids of documents in order, cut into frames."""

    def __init__(self, path: str, id_type: pa.DataType):
        system, at = _place(path)
        system.create_dir(os.path.dirname(at), recursive=True)
        self._out = system.open_output_stream(at, compression=None)
        self._press = zstandard.ZstdCompressor(level=3)
        self._waiting = io.BytesIO()
        self._table: list[tuple[int, int, int]] = []
        self._ids: list[pa.Array] = []
        self._counts: list[int] = []
        self._type = id_type

    def add(self, ids: pa.Array, contents: list[bytes]) -> None:
        """Documents with the stored form of their ids."""
        self._ids.append(ids)
        for content in contents:
            self._counts.append(len(content) // 4)
            self._waiting.write(content)
            if self._waiting.tell() >= 4 * FRAME_IDS:
                self._cut(FRAME_IDS * 4)

    def _cut(self, size: int) -> None:
        whole = self._waiting.getvalue()
        at = 0
        while len(whole) - at >= size and at < len(whole):
            self._frame(whole[at : at + size])
            at += size
        self._waiting = io.BytesIO()
        self._waiting.write(whole[at:])

    def _frame(self, content: bytes) -> None:
        pressed = self._press.compress(content)
        self._out.write(pressed)
        self._table.append((len(pressed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> tuple[int, int, int]:
        """Documents, ids and frames of the file."""
        if rest := self._waiting.getvalue():
            self._frame(rest)
        frames = len(self._table)
        index = pa.table([pa.chunked_array(self._ids, self._type), pa.array(self._counts, pa.int64())], names=["id", "n"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_table(index)
        pressed = self._press.compress(sink.getvalue().to_pybytes())
        self._out.write(struct.pack("<II", _INDEX_MAGIC, len(pressed)) + pressed)
        self._table.append((len(pressed) + 8, 0, xxhash.xxh64_intdigest(pressed) & 0xFFFFFFFF))
        rows = b"".join(struct.pack("<III", *row) for row in self._table)
        footer = struct.pack("<IBI", len(self._table), _CHECKSUMS, _END_MAGIC)
        self._out.write(struct.pack("<II", _TABLE_MAGIC, len(rows) + _FOOTER) + rows + footer)
        self._out.close()
        return len(self._counts), sum(self._counts), frames


class Reader:
    """One file: the index, and frames as they are asked for. A frame that fails its checksum raises ValueError."""

    def __init__(self, path: str):
        system, at = _place(path)
        self.path, self._file = path, system.open_input_file(at)
        size = self._file.size()
        frames, kind, magic = struct.unpack("<IBI", self._file.read_at(_FOOTER, size - _FOOTER))
        if (kind, magic) != (_CHECKSUMS, _END_MAGIC):
            raise ValueError(f"{path}: no seek table with checksums at the end")
        rows = self._file.read_at(12 * frames, size - _FOOTER - 12 * frames)
        self.table = np.frombuffer(rows, "<u4").reshape(-1, 3).astype(np.int64)
        self.ends = np.cumsum(self.table[:, 0])
        self._unpress = zstandard.ZstdDecompressor()
        pressed = self._file.read_at(int(self.table[-1, 0]) - 8, int(self.ends[-1] - self.table[-1, 0]) + 8)
        self._check(pressed, frames - 1)
        index = pa.ipc.open_stream(self._unpress.decompress(pressed)).read_all()
        self.ids, self.counts = index.column(0), index.column(1).to_numpy()
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        self.frames_read = 0
        self._last: tuple[int, bytes] = (-1, b"")

    def _check(self, content: bytes, frame: int) -> None:
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[frame, 2]:
            raise ValueError(f"{self.path}: frame {frame} fails its checksum")

    def frame(self, k: int) -> bytes:
        """The stored ids of a frame; the last one read is kept."""
        if self._last[0] != k:
            size = int(self.table[k, 0])
            content = self._unpress.decompress(self._file.read_at(size, int(self.ends[k]) - size))
            self._check(content, k)
            self._last = (k, content)
            self.frames_read += 1
        return self._last[1]

    def pieces(self, document: int) -> Iterator[bytes]:
        """The stored ids of a document, frame by frame."""
        at, end = int(self.starts[document]), int(self.starts[document + 1])
        while at < end:
            k, skip = divmod(at, FRAME_IDS)
            taken = min(end - at, FRAME_IDS - skip)
            yield self.frame(k)[4 * skip : 4 * (skip + taken)]
            at += taken


def write(
    docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int | None = 1, id_column: str = "doc_id",
    text_column: str = "text", shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Encode every whole text, ``end_id`` behind it, and write shards; returns a row per file.

    (shard, path, documents, ids, frames, start): ``start`` is the number of ids in all shards before. Shards
    ascend by id (null first); rows of one id ascend by a hash of the text, equal rows are interchangeable
    and repeated ones stay. A null text is empty. ``tokenizer`` is a tokenizer file on the driver. ``folder`` must be
    reachable by every task (default: a new one in the shared folder). An empty table makes no file. A document longer than ``shard_bytes``
    lies in one file, in many frames.
    """
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/llm-tokens-{uuid.uuid4().hex}"
    with open(tokenizer, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tie = F.xxhash64("text").alias("tie")
    dealt = rows.repartitionByRange(total // shard_bytes + 1, "id", tie, F.monotonically_increasing_id())
    dealt = dealt.sortWithinPartitions("id", tie)
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = _encoder(content.value), None
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:07d}-{uuid.uuid4().hex}.zst"
        for batch in slices(batches):
            writer = writer or Writer(path, batch.schema.field(0).type)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            writer.add(batch.column(0), [ids + end for ids in encoder.encode(texts)])
        if writer:
            documents, ids, frames = writer.close()
            yield pa.record_batch([pa.array([v]) for v in (shard, path, documents, ids, frames)], names=["shard", "path", "documents", "ids", "frames"])

    written = staged(dealt.mapInArrow(run, "shard long, path string, documents long, ids long, frames long"))
    return _with_starts(written)


def _with_starts(files: DataFrame, block: int = 4096) -> DataFrame:
    """``files`` with the ids before each: summed in blocks of shards, then over the blocks."""
    files = files.withColumn("block", F.floor(F.col("shard") / block))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    blocks = files.groupBy("block").agg(F.sum("ids").alias("all")).withColumn(
        "over", F.coalesce(F.expr(f"sum(all) OVER (ORDER BY block {before})"), F.lit(0))
    )
    within = F.coalesce(F.expr(f"sum(ids) OVER (PARTITION BY block ORDER BY shard {before})"), F.lit(0))
    return files.join(blocks, "block").select(*files.drop("block").columns, (within + F.col("over")).alias("start"))


def read(files: DataFrame, id_type: str, keep_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document, from the files; ``start`` counts over all shards.

    A frame is in memory at a time, and with ``keep_ids`` the ids of a few documents.
    """
    paths = files.select("path", "start")
    paths = paths.repartition(max(1, paths.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = Reader(path)
                for at in range(0, len(reader.counts), 256):
                    here = range(at, min(at + 256, len(reader.counts)))
                    yield _documents(reader, here, start, keep_ids)

    return paths.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * keep_ids)


def _documents(reader: Reader, wanted: Iterator[int], start: int, keep_ids: bool) -> pa.RecordBatch:
    wanted = list(wanted)
    crcs, ids = [], []
    for k in wanted:
        crc, own = 0, []
        for piece in reader.pieces(k):
            crc = zlib.crc32(piece, crc)
            if keep_ids:
                own.append(np.frombuffer(piece, "<u4").astype(np.int64))
        crcs.append(crc)
        ids.append(np.concatenate(own) if own else np.empty(0, np.int64))
    columns = [
        pa.concat_arrays(reader.ids.take(pa.array(wanted, pa.int64())).chunks), pa.array(reader.starts[wanted] + start, pa.int64()),
        pa.array(reader.counts[wanted], pa.int64()), pa.array(crcs, pa.int64()),
    ]
    names = ["id", "start", "n_tokens", "ids_crc32"]
    if keep_ids:
        columns.append(pa.array(ids, pa.list_(pa.int64())))
        names.append("ids")
    return pa.record_batch(columns, names=names)


def index(files: DataFrame, id_type: str) -> DataFrame:
    """(path, start, place, id) of every document: file, the file's start, row in the file; no frame is read."""
    paths = files.select("path", "start")
    paths = paths.repartition(max(1, paths.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader, n = Reader(path), 0
                for chunk in reader.ids.chunks:
                    rows = len(chunk)
                    columns = [pa.array([path] * rows), pa.array([start] * rows), pa.array(range(n, n + rows), pa.int64()), chunk]
                    yield pa.record_batch(columns, names=["path", "start", "place", "id"])
                    n += rows

    return paths.mapInArrow(run, f"path string, start long, place long, id {id_type}")


def fetch(files: DataFrame, wanted: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of the documents whose id is in ``wanted``; only their frames are read.

    Ids asked for twice come once; rows that share an id all come; a null or unknown id has no row.
    """
    asked = wanted.select(F.col(f"`{id_column}`").alias("id")).where("id IS NOT NULL").distinct()
    kind = asked.schema["id"].dataType.simpleString()
    places = index(files, kind).join(asked, "id", "left_semi")
    places = places.repartitionByRange("path", "place").sortWithinPartitions("path", "place").select("path", "start", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in slices(batches):
            found: dict[tuple[str, int], list[int]] = {}
            for path, start, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault((path, start), []).append(place)
            for (path, start), rows in found.items():
                reader = reader if reader and reader.path == path else Reader(path)
                yield _documents(reader, rows, start, True)

    return places.mapInArrow(run, f"id {kind}, start long, n_tokens long, ids_crc32 long, ids array<long>")
