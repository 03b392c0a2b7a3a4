"""Substring deduplication by sliding spans of sentences.

A span is a run of two or more consecutive sentences and at least ``floor`` words, or one sentence of at
least ``least`` words. Of the runs only those are hashed that are as short as they can be with their first
sentence, or as short as they can be with their last: the result is that of hashing every run, since each
sentence of a longer one is in the shortest run that starts there, or in the shortest run that ends with
the longer one, and both repeat with it. What a passage has of a sentence that it cuts stays. Spans are
hashed over their lower-cased words, joined globally, and every sentence in a span that has occurred
before (in a document of smaller id, or earlier in the same) is removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cellstar.llm.shared import slices, staged

#: Words of a single sentence, and of a run of several: fewer are stock phrases.
LEAST_WORDS, FLOOR = 30, 12
#: Sentences end at their marks, with quotes, brackets or other signs after them, and at line ends. Each run of
#: signs is taken whole, so that long ones take linear time.
_SIGNS = re.compile(r"([^\w\s]++)(\s++)?|\n\s*+")
_MARK, _WIDE = re.compile(r"[.!?…]"), re.compile(r"[。！？]")


def _stops(signs: str) -> bool:
    """Whether a run of signs has a mark after its last comma, colon or semicolon."""
    return bool(_MARK.search(signs, max(signs.rfind(c) for c in ",;:") + 1))


def sentences(text: str) -> list[tuple[int, int]]:
    """Stretches that make up the whole text, each with the white space after it."""
    ends = [
        m.end() for m in _SIGNS.finditer(text)
        if not m[1] or m[2] and ("\n" in m[2] or _stops(m[1])) or _WIDE.search(m[1])
    ]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return list(zip([0, *ends], ends, strict=False))


def spans(text: str, least: int, floor: int = FLOOR) -> list[tuple[int, int, bytes]]:
    """(first, last, digest) of the text's spans, by sentence number."""
    words = [text[a:b].lower().split() for a, b in sentences(text)]
    at = [k for k, w in enumerate(words) if w]  # blank ones count for nothing
    words = [words[k] for k in at]
    upto = np.cumsum([0, *map(len, words)])
    floor = min(floor, least)
    if upto[-1] < floor:
        return []
    # Shortest run from each start, and to each end: both by where the running count has grown enough.
    place = np.arange(len(words))
    last = np.maximum(np.searchsorted(upto, upto[:-1] + floor) - 1, place + 1)
    first = np.minimum(np.searchsorted(upto, upto[1:] - floor, "right") - 1, place - 1)
    runs = {(i, int(j)) for i, j in enumerate(last) if j < len(words)}
    runs |= {(int(i), j) for j, i in enumerate(first) if i >= 0}
    runs |= {(i, i) for i, w in enumerate(words) if len(w) >= least}
    digest = xxhash.xxh3_128_digest
    digests = [digest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words]
    return [(at[i], at[j], digest(b"".join(digests[i : j + 1]))) for i, j in sorted(runs)]


def _digest(text: Column) -> list[Column]:
    """128 bits of the text, as two numbers: they tell rows of one id apart."""
    return [F.xxhash64(text).alias("r1"), F.xxhash64(F.lit(1), text).alias("r2")]


def _spans(rows: DataFrame, least: int, floor: int) -> DataFrame:
    """(id, r1, r2, i, j, hi, lo): all spans of all rows."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            each = [spans(t or "", least, floor) for t in batch.column(3).to_pylist()]
            place = pa.array(np.repeat(np.arange(len(each)), [len(e) for e in each]))
            flat = [s for e in each for s in e]
            digests = np.frombuffer(b"".join(s[2] for s in flat), np.int64).reshape(-1, 2)
            yield pa.record_batch(
                [*[batch.column(c).take(place) for c in range(3)], pa.array([s[0] for s in flat], pa.int32()),
                 pa.array([s[1] for s in flat], pa.int32()), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())],
                names=["id", "r1", "r2", "i", "j", "hi", "lo"],
            )

    return rows.mapInArrow(run, f"id {kind}, r1 bigint, r2 bigint, i int, j int, hi bigint, lo bigint")


def repeated_spans(docs: DataFrame, least: int, floor: int, id_column: str, text_column: str) -> DataFrame:
    """(id, r1, r2, i, j) of every span that is not the first of its digest; ids in order, null last."""
    text = F.col(f"`{text_column}`")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), *_digest(text), text.alias("text"))
    found = staged(_spans(rows, least, floor))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "r1", "r2", "i")
    # Each digest is reduced in the tasks before it is shuffled; what is joined back is a row per repeated digest.
    # Written first: its join then has two shuffles of its own, and Spark can split a hot digest.
    firsts = found.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = staged(firsts.where("n > 1").select("hi", "lo", "first"))
    return found.join(firsts, ["hi", "lo"]).where(place != F.col("first")).select("id", "r1", "r2", "i", "j")


def remove_repeats(
    docs: DataFrame, least: int = LEAST_WORDS, id_column: str = "doc_id", text_column: str = "text", prefix: str = "",
    floor: int = FLOOR,
) -> DataFrame:
    """``docs`` with repeated sentences cut out of the text, and n_sentences and n_removed added.

    A document all of whose sentences are repeats keeps its row, with an empty text. Null stays null, with no
    sentences. Rows equal in id and text count as one document and are cut alike; rows of one id (or none)
    with different texts are told apart by 128 bits of the text. ``prefix`` goes before the added names;
    columns that have one are replaced. Other columns may have any name, also one with a dot.
    """
    added = [f"{prefix}n_sentences", f"{prefix}n_removed"]
    docs = docs.drop(*added)
    names = docs.columns
    # Columns go by their places here, so that no name can clash.
    docs = docs.toDF(*[f"c{k}" for k in range(len(names))])
    doc_id, text = (f"c{names.index(c)}" for c in (id_column, text_column))
    cuts = repeated_spans(docs, least, floor, doc_id, text).groupBy("id", "r1", "r2").agg(
        F.collect_set(F.struct("i", "j")).alias("cuts")
    )
    joined = docs.select("*", *[d.alias(f"own{k}") for k, d in enumerate(_digest(F.col(text)))]).join(
        cuts, F.col(doc_id).eqNullSafe(F.col("id")) & (F.col("own0") == F.col("r1")) & (F.col("own1") == F.col("r2")), "left"
    )
    rows = joined.select(*docs.columns, "cuts")
    place, last = names.index(text_column), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, counts, gone = [], [], []
            for text, cut in zip(batch.column(place).to_pylist(), batch.column(last).to_pylist(), strict=True):
                parts = sentences(text) if text else []
                drop = np.zeros(len(parts), bool)
                for c in cut or []:
                    drop[c["i"] : c["j"] + 1] = True
                texts.append("".join(text[a:b] for (a, b), d in zip(parts, drop, strict=True) if not d) if drop.any() else text)
                counts.append(len(parts))
                gone.append(int(drop.sum()))
            columns = list(batch.columns)[:-1]
            columns[place] = pa.array(texts, pa.string())
            columns += [pa.array(counts, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], "n", "gone"])

    schema = StructType([*docs.schema.fields, StructField("n", LongType()), StructField("gone", LongType())])
    return rows.mapInArrow(run, schema).toDF(*names, *added)
