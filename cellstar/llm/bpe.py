"""BPE encoding and decoding with a public word-level byte-pair vocabulary.

Text between special tokens is NFC-normalised, lower-cased and cut into words; a word becomes the
characters of its bytes, the last one with the end-of-word suffix, and adjacent parts are merged by
rank. A short word is a contiguous array of part boundaries beside an array of the ranks of
adjacent pairs: scan for the minimum, delete that boundary, refresh the two neighbouring ranks. A long
word takes the same merges in the same order from a heap. Words repeat, so each worker keeps what
it has encoded; what it keeps is bounded, and dropping it changes no result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.shared import slices

#: Longest word (in parts) that is scanned rather than queued, and longest chunk kept.
SHORT = 96
#: Chunks a worker keeps.
KEPT = 200_000
#: Unicode white space, as the vocabulary's normalizer replaces it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What Python's str.split() takes for white space beyond that.
_ODD = regex.compile(r"[\x1c-\x1f]")
_CHUNK = regex.compile(f"[^{SPACE}]+")
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
_NEVER = 1 << 60


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Vocabulary:
    """A tokenizer file: words to ids and back."""

    kept = KEPT

    def __init__(self, content: str):
        file = json.loads(content)
        model = file["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {
            (self.ids[a], self.ids[b]): (rank, self.ids[a.removesuffix(self.suffix) + b])
            for rank, (a, b) in enumerate(merges)
        }
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.texts = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self._split = regex.compile("(" + "|".join(names) + ")") if names else None
        self._bytes = byte_characters()
        self._known: dict[str, tuple[int, str, str, tuple[int, ...]]] = {}

    def word(self, word: str) -> list[int]:
        """Ids of one word."""
        marks = [self._bytes[b] for b in word.encode()]
        marks[-1] += self.suffix
        parts = [self.ids[m] for m in marks]
        return self._scanned(parts) if len(parts) <= SHORT else self._queued(parts)

    def _scanned(self, parts: list[int]) -> list[int]:
        merges = self.merges
        none = (_NEVER, 0)
        ranks = [merges.get(p, none) for p in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least is none or least[0] == _NEVER:
                break
            i = ranks.index(least)
            parts[i] = least[1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = merges.get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = merges.get((parts[i], parts[i + 1]), none)
        return parts

    def _queued(self, parts: list[int]) -> list[int]:
        merges, n = self.merges, len(parts)
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        queue = [(m[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (m := merges.get((parts[i], parts[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i] = merges[left, right][1]
            alive[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (m := merges.get((parts[a], parts[b]))):
                    heapq.heappush(queue, (m[0], a, parts[a], parts[b]))
        return [p for p, here in zip(parts, alive, strict=True) if here]

    def _chunk(self, chunk: str) -> tuple[int, str, str, tuple[int, ...]]:
        """Of text without white space: number of ids, ids as text, decoded text, ids."""
        # Lower-casing is by character, without the final form of sigma.
        text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        ids = tuple(i for w in _WORD.findall(text) for i in self.word(w))
        entry = (len(ids), " ".join(map(str, ids)), self.decode(ids), ids)
        if len(chunk) <= SHORT:
            if len(self._known) >= self.kept:
                self._known.clear()
            self._known[chunk] = entry
        return entry

    def entries(self, text: str) -> list[tuple[int, str, str, tuple[int, ...]]]:
        """Of the whole text, chunk by chunk."""
        out, known = [], self._known
        for piece in self._split.split(text) if any(s in text for s in self.special) else (text,):
            if piece in self.special:
                i = self.special[piece]
                out.append((1, str(i), piece, (i,)))
                continue
            chunks = _CHUNK.findall(piece) if _ODD.search(piece) else piece.split()
            out += [known.get(c) or self._chunk(c) for c in chunks]
        return out

    def encode(self, text: str) -> list[int]:
        return [i for e in self.entries(text) for i in e[3]]

    def decode(self, ids: list[int] | tuple[int, ...]) -> str:
        """Token texts, special ones included, with a space between."""
        texts = self.texts
        return " ".join([texts[i] for i in ids if i in texts])


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(content: str, kept: int = KEPT) -> Vocabulary:
    """The vocabulary of a tokenizer file's text, parsed once per worker, keeping that many chunks."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(content)
    _LOADED[key].kept = kept
    return _LOADED[key]


def _shared(frame: DataFrame, path: str):
    """The tokenizer file, read on the driver: a public vocabulary of one or two megabytes."""
    with open(path, encoding="utf-8") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, path: str, keep_ids: bool = True, id_column: str = "doc_id", text_column: str = "text",
    kept: int = KEPT,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row; a null text is empty.

    ``path`` is the tokenizer file on the driver. The digests are of the decimal ids joined by a space
    and of the decoded text. ``kept`` bounds the chunks a worker keeps, about half a kilobyte each. Repeated rows and null ids stay as they are; an empty text has no ids.
    """
    content = _shared(docs, path)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(content.value, kept)
        sha = hashlib.sha256
        for batch in slices(batches):
            counts, digests, texts, ids = [], [], [], []
            for text in batch.column(1).to_pylist():
                entries = known.entries(text or "")
                counts.append(sum([e[0] for e in entries]))
                # A chunk of white space only in the vocabulary's eyes has no ids.
                digests.append(sha(" ".join([e[1] for e in entries if e[0]]).encode()).hexdigest())
                texts.append(sha(" ".join([e[2] for e in entries if e[0]]).encode()).hexdigest())
                if keep_ids:
                    ids.append(np.fromiter((i for e in entries for i in e[3]), np.int32, counts[-1]))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names=names)

    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + ", ids array<int>" * keep_ids)


def decode(rows: DataFrame, path: str, id_column: str = "id", ids_column: str = "ids") -> DataFrame:
    """(id, text) of encoded rows; null ids decode to an empty text, unknown ids are left out."""
    content = _shared(rows, path)
    rows = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{ids_column}`").alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(content.value)
        for batch in slices(batches):
            texts = [known.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return rows.mapInArrow(run, f"id {kind}, text string")
