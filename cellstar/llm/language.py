"""Language identification: sparse multinomial logistic regression on character n-grams.

A text's letters are lower-cased, everything else becomes one space, and its 2- and 3-grams are
counted in 2**14 hashed places: whole texts, in pieces of bounded size. Weights are sublinear
TF-IDF of unit length. Document frequencies come from every training document; the classifier is
fitted on a bounded sample of them, by follow-the-regularised-leader with an L1 and an L2 penalty,
and its probabilities are calibrated by one temperature on a part of the sample it has not seen.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cellstar.llm.shared import by_place, slices, staged

PLACES = 1 << 14
#: Labelled documents the classifier is fitted on: in all, and of one language.
SAMPLE, PER_LANGUAGE = 6000, 600
UNKNOWN = "und"
_PIECE = 1 << 20
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or a space."""
    if not _LETTERS:
        table = np.full(0x110000, 32, np.uint32)
        for code in range(0x110000):
            if (c := chr(code)).isalpha():
                table[code] = ord(c.lower()[0])
        _LETTERS.append(table)
    return _LETTERS[0]


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of the whole text; None if it has no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(PLACES, np.int64)
    tail, any_letter = np.array([32], np.uint32), False
    for at in range(0, max(len(codes), 1), _PIECE):
        piece = _letters()[codes[at : at + _PIECE]]
        if at + _PIECE >= len(codes):
            piece = np.append(piece, np.uint32(32))
        piece = np.concatenate([tail, piece])
        blank = piece == 32
        any_letter |= not blank.all()
        keep = np.ones(len(piece), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        piece = piece[keep]
        two = (piece[:-1] * np.uint32(0x9E3779B1) + piece[1:]) * np.uint32(0x85EBCA6B)
        three = (two[:-1] + piece[2:]) * np.uint32(0xC2B2AE35)
        # The last two letters were the head of the next piece's first 3-gram, so a 2-gram is not counted twice.
        fresh = two if at == 0 else two[len(tail) - 1 :]
        total += np.bincount(fresh >> np.uint32(18), minlength=PLACES)
        total += np.bincount(three >> np.uint32(18), minlength=PLACES)
        tail = piece[-2:]
    return total if any_letter else None


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def vector(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = (1 + np.log(counts)) * self.idf[places]
        return values / max(np.sqrt(values @ values), 1e-12)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        places = np.flatnonzero(counts)
        scores = self.vector(places, counts[places]) @ self.weights[places] + self.weights[PLACES]
        return _softmax(scores / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and probability; unknown with 0 where there is no letter, or nothing was learned."""
        counts = gram_counts(text) if text and self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        p = self.probabilities(counts)
        best = int(p.argmax())
        return self.languages[best], float(min(p[best], 1.0))


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_weights(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.5,
) -> np.ndarray:
    """FTRL-proximal over rows (places, values, class); the last weight is the bias, which is not penalised."""
    z = np.zeros((PLACES + 1, classes))
    n = np.zeros_like(z)
    first, second = np.full((PLACES + 1, 1), l1), np.full((PLACES + 1, 1), l2)
    first[PLACES] = second[PLACES] = 0

    def weights(at: np.ndarray | slice) -> np.ndarray:
        scale = (beta + np.sqrt(n[at])) / alpha + second[at]
        return np.where(np.abs(z[at]) <= first[at], 0.0, (np.sign(z[at]) * first[at] - z[at]) / scale)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            places, values, label = rows[k]
            at, x = np.append(places, PLACES), np.append(values, 1.0)
            w = weights(at)
            off = _softmax(x @ w)
            off[label] -= 1
            g = np.outer(x, off)
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / alpha * w
    return weights(slice(None))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log likelihood on held-back scores, on a fixed grid."""
    if not len(scores):
        return 1.0
    grid = np.geomspace(0.05, 20, 200)
    losses = [-np.log(np.maximum(_softmax(scores / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def train(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> Model:
    """Learn from the rows given. Rows without a label or a letter teach nothing; no rows, no languages.

    Per language at most ``PER_LANGUAGE`` (of ``SAMPLE`` in all, at least 20) documents, those of least
    hashed id, are sent to the driver as n-gram counts, and with them one sum per place.
    """
    rows = labelled.select(
        F.xxhash64(F.col(f"`{id_column}`").cast("string")).alias("hash"), F.col(f"`{text_column}`").alias("text"),
        F.col(f"`{label_column}`").alias("lang"),
    ).where("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return Model([], np.zeros(PLACES), np.zeros((PLACES + 1, 0)))
    most = max(20, min(PER_LANGUAGE, SAMPLE // len(sizes)))
    # Hashes below this hold somewhat more than that many rows; what is over is cut when they are gathered.
    below = {lang: int(-(2**63) + min(1.0, (most + 5 * most**0.5) / n) * (2**64 - 1)) for lang, n in sizes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, documents = np.zeros(PLACES, np.int64), 0
        kept: dict[str, list[tuple[int, int, np.ndarray, np.ndarray]]] = {}
        for batch in slices(batches):
            for h, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = gram_counts(text)
                if counts is None:
                    continue
                found += counts > 0
                documents += 1
                if h <= below[lang]:
                    heap = kept.setdefault(lang, [])
                    at = np.flatnonzero(counts).astype(np.int32)
                    heapq.heappush(heap, (-h, documents, at, counts[at].astype(np.int32)))
                    if len(heap) > most:
                        heapq.heappop(heap)
        places = np.flatnonzero(found)
        out = [(None, documents, places, found[places])]
        for lang, heap in kept.items():
            out += [(lang, -h, at, n) for h, _, at, n in heap]
        for part in range(0, len(out), 64):
            columns = list(zip(*out[part : part + 64], strict=True))
            yield pa.record_batch(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.list_(pa.int32())), pa.array(columns[3], pa.list_(pa.int64()))],
                names=["lang", "rank", "at", "n"],
            )

    gathered = staged(rows.mapInArrow(run, "lang string, rank bigint, at array<int>, n array<bigint>"))
    found = np.zeros(PLACES)
    sums = gathered.where("lang is null")
    documents = sums.agg(F.sum("rank")).first()[0] or 0
    for at, n in sums.select(F.explode(F.arrays_zip("at", "n")).alias("p")).groupBy("p.at").agg(F.sum("p.n")).collect():
        found[at] = n
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "at"))
    sample = gathered.where("lang is not null").withColumn("place", place).where(F.col("place") <= most)
    each = sorted(sample.select("lang", "rank", "at", "n").collect(), key=lambda r: (r.rank, r.lang, r.at))
    languages = sorted({r.lang for r in each})
    model = Model(languages, np.log((1 + documents) / (1 + found)) + 1, np.zeros((PLACES + 1, len(languages))))
    data = []
    for r in each:
        at = np.array(r.at)
        data.append((at, model.vector(at, np.array(r.n, float)), languages.index(r.lang)))
    fit, kept = [d for i, d in enumerate(data) if i % 5], [d for i, d in enumerate(data) if i % 5 == 0]
    if len({d[2] for d in fit}) < len(languages):
        fit = data
    model.weights = fit_weights(fit, len(languages))
    scores = np.array([x @ model.weights[at] + model.weights[PLACES] for at, x, _ in kept])
    model.temperature = fit_temperature(scores, np.array([d[2] for d in kept]))
    return model


def predict(docs: DataFrame, model: Model, text_column: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred and score added (replacing columns so named), from the text alone.

    ``prefix`` goes before the names of the added columns.

    A null, empty or letterless text is ``und`` with score 0. Repeated rows stay, each judged alike. Other
    columns may have any name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"{prefix}lang_pred", f"{prefix}score"]
    docs = docs.drop(*names)
    rows, place = by_place(docs), docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            found = [known.predict(t) for t in batch.column(place).to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64()))]
            yield pa.record_batch([*batch.columns, *columns], names=[*batch.schema.names, "pred", "score"])

    schema = StructType([*rows.schema.fields, StructField("pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema).toDF(*docs.columns, *names)


def identify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", prefix: str = ""
) -> DataFrame:
    """``docs`` with held_out, lang_pred and score, by a model of the documents that are not held out."""
    hidden = F.coalesce(held_out(F.col(f"`{id_column}`")), F.lit(False))
    model = train(docs.where(~hidden), id_column, text_column, label_column)
    return predict(docs, model, text_column, prefix).withColumn(f"{prefix}held_out", hidden)
