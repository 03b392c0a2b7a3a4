"""Personal data: base patterns, and a skip-chain conditional random field over each document.

The base finds e-mail addresses, IP addresses, card and phone numbers by their form. The field's
nodes are the tokens (runs without white space) that hold a digit or an at sign; tokens of one base
span are one node, and so are number parts with only spaces between, so that a number in parts is
never cut. No other token can be personal data: the chain falls apart at them, and they only serve as
context. Adjacent nodes share a transition potential; equal or similar nodes of a document (same
letters and digits, or numbers whose last seven digits are the same) share an agreement potential
however far apart. Nodes in base spans are given, and loopy message passing carries their labels to
the others. The potentials are learned from the base's own finds in a bounded sample of documents, by
pseudo-likelihood; nodes that the base missed but that agree with one it found are latent there.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.shared import by_place, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
FEATURES = 1 << 12
#: Documents looked at for training, those of them used, and the most nodes of one that is used.
SAMPLE_DOCS, TRAIN_DOCS, TRAIN_NODES = 20_000, 1_500, 400
#: Marginal from which a token gets its label, and rounds of message passing.
SURE, ROUNDS = 0.9, 30
#: Mean of the agreement potentials before learning: documents seldom repeat what the base finds.
AGREE = 8.0
#: Digits at the end that similar numbers share.
TAIL = 7

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, since the last part takes the whole run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HIT = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
_SPACE = re.compile(r"\s")
# A number part that may go on after a space, and one that may follow; a point ends a sentence unless a plus came before.
_GOES_ON, _FOLLOWS = re.compile(r"[+(]*[0-9][().0-9-]*\Z"), re.compile(r"\(?[0-9][().0-9-]*[,;:!?\"'\]}>]*\Z")
_EDGE = " \t\n\r,.;:!?\"'()[]{}<>"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        at += 1
        if found:
            done = at = found.end()
            yield "email", start, done


def base_spans(text: str) -> list[Span]:
    """The base's finds, by kind and start; failing matches are dropped and not tried again."""
    out = list(_emails(text))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs without white space that hold a digit or an at sign."""
    out, at = [], 0
    while m := _HIT.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _SPACE.search(text, m.end())
        out.append((start, at := end.start() if end else len(text)))
    return out


def _owners(spans: list[tuple[int, int]], base: list[Span]) -> list[int]:
    """Number of the base span that each token meets (of the first kind, if several), -1 for none."""
    owners = [-1] * len(spans)
    starts = [s[0] for s in spans]
    for n, (_, start, end) in reversed(list(enumerate(base))):
        for k in range(max(bisect_right(starts, start) - 1, 0), len(spans)):
            if spans[k][0] >= end:
                break
            if spans[k][1] > start:
                owners[k] = n
    return owners


def nodes(text: str, base: list[Span]) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(places, labels) of the field's nodes; the label of a node outside the base is 0."""
    spans = tokens(text)
    places: list[tuple[int, int]] = []
    labels: list[int] = []
    before, plus = -1, False
    for (start, end), owner in zip(spans, _owners(spans, base), strict=True):
        joins = False
        if places and owner == before:
            last = places[-1][1]
            joins = owner >= 0 or (
                not text[last:start].strip(" ") and (plus or text[last - 1] != ".")
                and bool(_GOES_ON.match(text[at:last])) and bool(_FOLLOWS.match(text[start:end]))
            )
        if joins:
            places[-1] = places[-1][0], end
        else:
            places.append((start, end))
            labels.append(1 + KINDS.index(base[owner][0]) if owner >= 0 else 0)
            plus = text[start] == "+"
        before, at = owner, start
    return places, np.array(labels, np.int64)


def _shape(token: str) -> str:
    token = re.sub(r"[^\W\d_]+", "a", token)
    return re.sub(r"(.)\1+", r"\1\1", re.sub(r"[0-9]", "9", token))


def _word_before(text: str, start: int) -> str:
    end = start
    while end and text[end - 1].isspace():
        end -= 1
    start = end
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:end].strip(_EDGE).lower()


def _checksum(core: str) -> str:
    """Whether the numbers as long as a card's pass the checksum; empty where there are none."""
    numbers = ["".join(_DIGIT.findall(part)) for part in (core, *core.split())]
    passed = [luhn(n) for n in numbers if 16 <= len(n) <= 19]
    return str(any(passed)) if passed else ""


def features(text: str, span: tuple[int, int]) -> list[int]:
    """Hashed features of a node: its form, its digits and their checksum, its length, and the word before."""
    token = text[span[0] : span[1]]
    core = token.strip(_EDGE)
    digits = sum("0" <= c <= "9" for c in token)
    names = (
        f"s{_shape(core)}", f"d{min(digits, 24)}", f"l{min(len(core), 60) // 4}", f"@{'@' in core}{'.' in core}",
        f"+{core.startswith('+')}{core.count('.')}{core.count('-')}", f"w{_word_before(text, span[0])}",
        f"f{min(digits, 20)}/{min(len(core), 20)}", f"c{_checksum(core)}", "bias",
    )
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % FEATURES for n in names]


def edges(text: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(chain, skip): adjacent nodes, and each node with the last one before it that is equal or similar."""
    chain = [(i, i + 1) for i, (a, b) in enumerate(zip(spans, spans[1:], strict=False)) if text[a[1] : b[0]].isspace()]
    last: dict[str, int] = {}
    skip = []
    near = set(chain)
    for i, (start, end) in enumerate(spans):
        core = text[start:end].strip(_EDGE).lower()
        keys = {"t" + "".join(c for c in core if c.isalnum())}
        if not any(c.isalpha() for c in core):
            numbers = ("".join(_DIGIT.findall(part)) for part in (core, *core.split()))
            keys |= {"d" + n[-TAIL:] for n in numbers if len(n) >= TAIL}
        before = {last[k] for k in keys if k in last}
        skip += [(j, i) for j in sorted(before) if (j, i) not in near]
        last.update(dict.fromkeys(keys, i))
    return chain, skip


def latent(labels: np.ndarray, skip: list[tuple[int, int]]) -> np.ndarray:
    """The labels, with -1 for nodes outside the base that are linked, however indirectly, with one inside."""
    reached = labels > 0
    while True:
        count = reached.sum()
        for a, b in (*skip, *reversed(skip)):
            reached[a] = reached[b] = reached[a] or reached[b]
        if reached.sum() == count:
            return np.where(reached & (labels == 0), -1, labels)


@dataclass
class Field:
    unary: np.ndarray  # FEATURES x labels
    step: np.ndarray  # labels x labels, along the chain
    agree: np.ndarray  # labels, across skip edges

    def marginals(self, feats: np.ndarray, chain: list, skip: list, given: np.ndarray) -> np.ndarray:
        """Loopy sum-product, damped, in parallel over all edges; given tokens are fixed."""
        n, k = len(feats), len(LABELS)
        node = self.unary[feats].sum(1)
        node = np.where(given[:, None] > 0, np.where(np.arange(k) == given[:, None], 0.0, -1e3), node)
        pairs = np.array([*chain, *skip], np.int64).reshape(-1, 2)
        forth = np.concatenate([np.repeat(self.step[None], len(chain), 0), np.repeat(np.diag(self.agree)[None], len(skip), 0)])
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        table = np.concatenate([forth, forth.transpose(0, 2, 1)]).reshape(-1, k, k)
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        sent = np.zeros((len(source), k))
        belief = node
        for _ in range(ROUNDS if len(pairs) else 0):
            into = belief[source] - sent[back]
            new = np.logaddexp.reduce(into[:, :, None] + table, axis=1)
            new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
            change = np.abs(new - sent).max()
            sent = (sent + new) / 2
            belief = node.copy()
            np.add.at(belief, target, sent)
            if change < 1e-4:
                break
        belief = belief - belief.max(1, keepdims=True)
        p = np.exp(belief)
        return p / p.sum(1, keepdims=True)

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans of tokens outside the base that the field labels; adjacent ones of a kind are one span."""
        spans, given = nodes(text, base)
        if given.all():
            return []
        chain, skip = edges(text, spans)
        p = self.marginals(np.array([features(text, s) for s in spans]), chain, skip, given)
        label = np.where((p.max(1) >= SURE) & (given == 0), p.argmax(1), 0)
        out: list[Span] = []
        joined = set(chain)
        for i in np.flatnonzero(label):
            start, end = spans[i]
            core = text[start:end]
            start, end = start + len(core) - len(core.lstrip(_EDGE)), end - len(core) + len(core.rstrip(_EDGE))
            kind = LABELS[label[i]]
            if out and (i - 1, i) in joined and label[i - 1] == label[i]:
                out[-1] = (kind, out[-1][1], end)
            elif start < end:
                out.append((kind, start, end))
        return out


def fit(documents: list[tuple[np.ndarray, list, list, np.ndarray]], epochs: int = 60, rate: float = 0.5, l2: float = 1e-3) -> Field:
    """Pseudo-likelihood over (features, chain, skip, labels): each label given those of its neighbours.

    Latent nodes (label -1) are neither fitted nor given to others.
    """
    k = len(LABELS)
    field = Field(np.zeros((FEATURES, k)), np.zeros((k, k)), np.full(k, AGREE))
    means = (0.0, 0.0, AGREE)
    if not documents:
        field.unary[:, 0] = 5.0
        return field
    offsets = np.cumsum([0, *[len(d[0]) for d in documents]])
    feats = np.concatenate([d[0] for d in documents])
    labels = np.concatenate([d[3] for d in documents])
    chain, skip = (
        np.array([(a + o, b + o) for d, o in zip(documents, offsets, strict=False) for a, b in d[i]], np.int64).reshape(-1, 2)
        for i in (1, 2)
    )
    seen = (labels >= 0)[:, None]
    hot = np.eye(k)[labels] * seen
    sums = [np.full_like(x, 1e-6) for x in (field.unary, field.step, field.agree)]
    for _ in range(epochs):
        score = field.unary[feats].sum(1)
        np.add.at(score, chain[:, 1], hot[chain[:, 0]] @ field.step)
        np.add.at(score, chain[:, 0], hot[chain[:, 1]] @ field.step.T)
        for a, b in ((0, 1), (1, 0)):
            np.add.at(score, skip[:, a], hot[skip[:, b]] * field.agree)
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        off = (p / p.sum(1, keepdims=True) - hot) * seen
        unary, agree = np.zeros_like(field.unary), np.zeros_like(field.agree)
        for column in feats.T:
            np.add.at(unary, column, off)
        step = hot[chain[:, 0]].T @ off[chain[:, 1]] + off[chain[:, 0]].T @ hot[chain[:, 1]]
        for a, b in ((0, 1), (1, 0)):
            agree += (off[skip[:, a]] * hot[skip[:, b]]).sum(0)
        for weight, gradient, total, mean in zip((field.unary, field.step, field.agree), (unary, step, agree), sums, means, strict=True):
            gradient = gradient / len(labels) + l2 * (weight - mean) / 10
            total += gradient**2
            weight -= rate * gradient / np.sqrt(total)
    field.agree = np.maximum(field.agree, 0)
    return field


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Field:
    """The field learned from a sample of ``docs``: at most ``TRAIN_DOCS`` documents with nodes, of least
    hashed id among about ``SAMPLE_DOCS``. They come to the driver as features and labels."""
    total = docs.count()
    part = min(1.0, SAMPLE_DOCS / max(total, 1))
    rank = F.xxhash64(F.col(f"`{id_column}`").cast("string"))
    rows = docs.select(rank.alias("rank"), F.col(f"`{text_column}`").alias("text"))
    rows = rows.where((F.col("rank") <= min(2**63 - 1, int(-(2**63) + part * 2**64))) & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for rank, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans, labels = nodes(text, base_spans(text))
                if not 0 < len(spans) <= TRAIN_NODES:
                    continue
                chain, skip = edges(text, spans)
                flat = [f for s in spans for f in features(text, s)]
                labels = latent(labels, skip).tolist()
                out.append((rank, flat, [x for e in chain for x in e], [x for e in skip for x in e], labels))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), *[pa.list_(pa.int32())] * 4]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["rank", "f", "c", "s", "l"])

    found = rows.mapInArrow(run, "rank bigint, f array<int>, c array<int>, s array<int>, l array<int>")
    documents = []
    for r in found.orderBy("rank", "f", "l").limit(TRAIN_DOCS).collect():
        chain, skip = (list(map(tuple, np.array(x, np.int64).reshape(-1, 2).tolist())) for x in (r.c, r.s))
        documents.append((np.array(r.f).reshape(len(r.l), -1), chain, skip, np.array(r.l)))
    return fit(documents)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans) of every row: kind, start and end in code points, and whether the base found it.

    Spans are ordered by kind, then start. A null text is empty and has none. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                added = shared.value.added(text or "", base)
                flags = [(s, True) for s in base] + [(s, False) for s in added]
                flags.sort(key=lambda f: (KINDS.index(f[0][0]), f[0][1]))
                out.append([{"kind": s[0], "start": s[1], "end": s[2], "base": b} for s, b in flags])
            yield pa.record_batch([batch.column(0), pa.array(out, _FOUND)], names=["id", "spans"])

    return rows.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones together) replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text_column: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by its kind; all other columns as they are, whatever their names; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows, place = by_place(docs), docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text in batch.column(place).to_pylist():
                spans = base_spans(text) if text else []
                spans = spans + shared.value.added(text, spans) if text else []
                texts.append(masked(text, spans) if spans else text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.record_batch(columns, names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
