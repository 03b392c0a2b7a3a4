"""Spelling variants: words of a corpus, which of them are one edit apart, and the form each goes by.

A word and a neighbour at one edit share a half exactly, with its end of the word. Words are dealt by the halves that
words of their own or a neighbouring length would take, so a word meets, in one block, all words that could share its
half; a half with too many words is dealt over several blocks, each with all its searches. A block is a
delimited text of its words with a bidirectional FM-index: the transform of the text and of its reverse as
wavelet matrices, and intervals of suffix ranks kept in step in both. A search matches one half outward to
the delimiter, turns round, and extends across the other half, allowing one error anywhere. Words, not
pairs of words, are dealt, and no block grows with the corpus.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstar.llm.shared import slices, staged

#: Symbols of a block's text, searches taken at once, and words a task counts before it passes them on.
BLOCK, BATCH, COUNTED = 400_000, 8_192, 200_000
#: Texts from this length are scanned word by word rather than cut at once.
_LONG = 1 << 22
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _noisy(key: str, word: str, modulus: int) -> str:
    """The lower-cased word, without one code point if its hash says so."""
    word = word.lower() if word.isascii() else word.translate(_LOWER)
    h = zlib.crc32(f"{key}:{word}".encode())
    if h % modulus:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = 7, least_count: int = 2,
    letters: str = r"A-Za-zÀ-ÿ", modulus: int = 31,
) -> DataFrame:
    """(word, n): words of at least ``least_length`` code points that occur ``least_count`` times in all texts.

    Words are maximal runs of ``letters``, A-Z lower-cased. The unsigned crc32 h of ``<id>:<word>`` plants
    misspellings: where ``modulus`` divides h, code point h modulo the length is deleted. A null id is
    written as nothing; a null or empty text has no words; repeated rows count again. Tasks count before they
    shuffle, in bounded tables.
    """
    run = re.compile(f"[{letters}]{{{least_length},}}")
    rows = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                found = run.findall(text) if len(text) < _LONG else (m.group() for m in run.finditer(text))
                for word, n in Counter(found).items():
                    word = _noisy(key or "", word, modulus)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Wavelet:
    """Ranks in a sequence of small integers: a bit of every symbol a level, counted up."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels = []
        for b in reversed(range(bits)):
            ones = ((sequence >> b) & 1).astype(bool)
            counts = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(ones, out=counts[1:])
            self.levels.append((b, counts, len(sequence) - int(counts[-1])))
            sequence = np.concatenate((sequence[~ones], sequence[ones]))
        symbols = np.arange(1 << bits)
        first = np.searchsorted(np.sort(sequence), symbols)
        place, _, _ = self.narrow(np.zeros_like(symbols), np.zeros_like(symbols), symbols)
        #: From a place on the last level to the rank among all suffixes.
        self.shift = first - place

    def narrow(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval of ``symbol`` within [lo, hi) on the last level, and how many smaller symbols [lo, hi) holds."""
        less = np.zeros_like(lo)
        for b, counts, zeros in self.levels:
            low, high = counts[lo], counts[hi]
            one = (symbol >> b) & 1 == 1
            less += np.where(one, (hi - high) - (lo - low), 0)
            lo, hi = np.where(one, zeros + low, lo - low), np.where(one, zeros + high, hi - high)
        return lo, hi, less

    def children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every symbol within each [lo, hi): number of the interval, symbol, its interval, smaller symbols."""
        at, symbol, less = np.arange(len(lo)), np.zeros_like(lo), np.zeros_like(lo)
        for _, counts, zeros in self.levels:
            low, high = counts[lo], counts[hi]
            sides = (
                (at, symbol << 1, lo - low, hi - high, less),
                (at, symbol << 1 | 1, zeros + low, zeros + high, less + (hi - high) - (lo - low)),
            )
            at, symbol, lo, hi, less = (np.concatenate(both) for both in zip(*sides, strict=True))
            some = np.flatnonzero(hi > lo)
            at, symbol, lo, hi, less = at[some], symbol[some], lo[some], hi[some], less[some]
        return at, symbol, lo, hi, less


def rotations(sequence: np.ndarray, bits: int) -> np.ndarray:
    """Starts of the sorted rotations of a sequence whose rotations all differ, by doubling."""
    step = 62 // bits
    rank = np.zeros(len(sequence), np.int64)
    for k in range(step):
        rank = rank << bits | np.roll(sequence, -k)
    while True:
        order = np.argsort(rank, kind="stable")
        ahead = rank[order]
        new = np.empty_like(rank)
        new[order] = np.concatenate(([0], np.cumsum(ahead[1:] != ahead[:-1])))
        if new[order[-1]] == len(sequence) - 1:
            return order
        rank = new * len(sequence) + np.roll(new, -step)
        step *= 2


_END, _SPLIT = 0, 1


class Block:
    """Bidirectional index of the text ``|w1|w2|...|wn|``."""

    def __init__(self, vocabulary: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in vocabulary]
        letters, codes = np.unique(np.concatenate(points), return_inverse=True)
        codes = codes.astype(np.int64) + 2
        self.lengths = np.array([len(p) for p in points])
        starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.codes, self.starts = codes, starts[:-1]
        bits = int(len(letters) + 1).bit_length()
        # The end of the text, then a delimiter before and behind every word.
        text = np.full(len(codes) + len(vocabulary) + 2, _SPLIT, np.int64)
        text[0] = _END
        place = np.arange(len(codes)) + 2 + np.repeat(np.arange(len(vocabulary)), self.lengths)
        text[place] = codes
        back = np.concatenate((text[:1], text[:0:-1]))
        self.size = len(text)
        self.order = rotations(text, bits)
        self._sides = (Wavelet(text[self.order - 1], bits), Wavelet(back[rotations(back, bits) - 1], bits))
        self.word_at = np.cumsum(text == _SPLIT) - 1

    def near(self, queries: np.ndarray, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for words that share the first half with a query, or if ``mirrored`` the last, at one edit.

        Queries are numbers of words; the first half is the shorter one. An edit at the seam belongs to both.
        """
        here, there = self._sides[::-1] if mirrored else self._sides
        length = self.lengths[queries]
        half = (length + 1) // 2 if mirrored else length // 2

        def symbol(q: np.ndarray, at: np.ndarray) -> np.ndarray:
            """The code at a place of a query, the delimiter outside it."""
            inside = (at >= 0) & (at < length[q])
            own = self.starts[queries[q]] + np.where(inside, length[q] - 1 - at if mirrored else at, 0)
            return np.where(inside, self.codes[own], _SPLIT)

        def outward(a: np.ndarray, b: np.ndarray, size: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
            lo, hi, less = here.narrow(a, a + size, c)
            return lo + here.shift[c], b + less, hi - lo

        def across(a: np.ndarray, b: np.ndarray, size: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
            lo, hi, less = there.narrow(b, b + size, c)
            return a + less, lo + there.shift[c], hi - lo

        # One half exactly, from the seam to the delimiter: its word is in the block, so no interval is empty.
        q = np.arange(len(queries))
        a, b, size = np.zeros_like(q), np.zeros_like(q), np.full_like(q, self.size)
        for back in range(int(half.max(initial=0)) + 1):
            on = np.flatnonzero(half >= back)
            a[on], b[on], size[on] = outward(a[on], b[on], size[on], symbol(on, half[on] - 1 - back))

        # Across the other half without an error so far, branching into one error at each place.
        erred: list[tuple[np.ndarray, ...]] = []
        at = half.copy()
        while len(q):
            own, last = symbol(q, at), at == length[q]
            k, c, lo, hi, less = there.children(b, b + size)
            letter = (c > _SPLIT) & (c != own[k])
            k, c, lo, hi, less = k[letter], c[letter], lo[letter], hi[letter], less[letter]
            child = (a[k] + less, lo + there.shift[c], hi - lo)
            erred.append((q[k], at[k], *child))
            put = ~last[k]
            erred.append((q[k][put], at[k][put] + 1, *(v[put] for v in child)))
            # Of equal letters in a row, one deletion stands for all.
            gone = np.flatnonzero(~last & ((at == half[q]) | (own != symbol(q, at - 1))))
            erred.append((q[gone], at[gone] + 1, a[gone], b[gone], size[gone]))
            a, b, size = across(a, b, size, own)
            on = np.flatnonzero((size > 0) & ~last)
            q, at, a, b, size = q[on], at[on] + 1, a[on], b[on], size[on]

        # To the delimiter without a further error.
        q, at, a, b, size = (np.concatenate(v) for v in zip(*erred, strict=True)) if erred else (q, at, a, b, size)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(q):
            last = at == length[q]
            a, b, size = across(a, b, size, symbol(q, at))
            done = np.flatnonzero(last & (size > 0))
            # A word between its delimiters occurs once; its interval in the text itself names it.
            rank = (b if mirrored else a)[done]
            found.append((q[done], self.word_at[self.order[rank]]))
            on = np.flatnonzero(~last & (size > 0))
            q, at, a, b, size = q[on], at[on] + 1, a[on], b[on], size[on]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(v) for v in zip(*found, strict=True)], axis=1), axis=0)
        return queries[pairs[:, 0]], pairs[:, 1]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) of the searches of one block."""
    rows = pa.Table.from_batches(batches).to_pydict()
    counts: dict[str, int] = dict(zip(rows["word"], rows["n"], strict=True))
    vocabulary = list(counts)
    number = {w: k for k, w in enumerate(vocabulary)}
    block = Block(vocabulary)
    last_half = bool(rows["last_half"][0])
    held = {(h, w) for h, w, t in zip(rows["half"], rows["word"], rows["held"], strict=True) if t}
    asked = np.array(sorted(number[w] for w, s in zip(rows["word"], rows["search"], strict=True) if s), np.int64)
    for k in range(0, len(asked), BATCH):
        q, t = block.near(asked[k : k + BATCH], last_half)
        pairs = [(vocabulary[i], vocabulary[j]) for i, j in zip(q.tolist(), t.tolist(), strict=True)]
        # Each word is held once under a half, whatever else has brought it here.
        if last_half:  # those that also share the first half are found by it
            pairs = [(w, x) for w, x in pairs if (w[len(w) // 2 :], x) in held and not x.startswith(w[: len(w) // 2])]
        else:
            pairs = [(w, x) for w, x in pairs if (w[: len(w) // 2], x) in held]
        columns = [pa.array([w for w, _ in pairs], pa.string()), pa.array([x for _, x in pairs], pa.string()), pa.array([counts[x] for _, x in pairs], pa.int64())]
        yield pa.record_batch(columns, names=["word", "near", "near_n"])


def _entries(word: Column, n: Column, last_half: bool) -> Column:
    """The word under each half that a word of a neighbouring length would take of it, and as a search under its own."""

    def part(length: Column) -> Column:
        size = F.floor((length + 1) / 2) if last_half else F.floor(length / 2)
        size = size.cast("int")
        return F.substring(word, F.char_length(word) - size + 1, size) if last_half else F.substring(word, F.lit(1), size)

    length = F.char_length(word)
    keys = F.array_distinct(F.array(part(length - 1), part(length), part(length + 1)))
    entry = lambda key, search: F.struct(F.lit(last_half).alias("last_half"), key.alias("half"), word.alias("word"), n.alias("n"), search.alias("search"))
    return F.transform(keys, lambda k: entry(k, k == part(length)))


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) for each two words of ``vocabulary`` (word, n) at exactly one edit, in both directions.

    An edit inserts, deletes or replaces one code point. Words must be distinct; null words are no words, and the empty word has
    no neighbours. Memory of a task is that of a block of about ``block`` symbols, or of its longest word.
    """
    rows = vocabulary.select(F.col("word"), F.col("n").cast("long").alias("n")).where("word <> ''")
    both = F.concat(_entries(F.col("word"), F.col("n"), False), _entries(F.col("word"), F.col("n"), True))
    entries = staged(rows.select(F.inline(both)))
    weight = F.sum(F.char_length("word") + 1)
    total = entries.agg(weight).first()[0] or 0
    large = entries.groupBy("last_half", "half").agg(weight.alias("weight"), F.count("*").alias("words")).where(F.col("weight") > block)
    parts = F.least(F.ceil(F.col("weight") / block), F.col("words")).cast("int")
    large = staged(large.select("last_half", "half", parts.alias("parts")))
    found = entries.join(large, ["last_half", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    # Words of a large half are dealt over its parts, its searches go to each.
    to = F.when(F.col("search"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    dealt = found.select("last_half", "half", "word", "n", "search", own.alias("own"), F.explode(to).alias("part"))
    spread = F.pmod(F.xxhash64("half", "part"), F.lit(total // block + 1))
    held = (F.col("own") == F.col("part")).alias("held")
    dealt = dealt.select("last_half", spread.alias("bucket"), "half", "word", "n", "search", held)
    return dealt.groupBy("last_half", "bucket").applyInArrow(_searched, "word string, near string, near_n long")


def group(vocabulary: DataFrame, ratio: int = 10, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``vocabulary`` (word, n).

    ``form`` is the near word of largest n (ties: smallest in code-point order) if that is at least ``ratio`` times the
    word's own, else null; ``root`` follows forms to the last. As counts grow by ``ratio`` a step, chains are short
    and end; ``ratio`` must be over 1.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1, else forms could go in circles")
    vocabulary = staged(vocabulary.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near")))
    near = near_words(vocabulary, block).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.minus") >= ratio * F.col("n")
    found = staged(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n"),
        )
    )
    up = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        over = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = staged(up.join(over, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not up.where("moved").take(1):
            break
        up = up.drop("moved")
    return found.join(up.drop("moved"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle() -> str:
    """DuckDB SQL of op13_spelling: neighbours by equal texts without one code point."""
    letters = "[A-Za-zÀ-ÿ]+"
    table = (
        "SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce([b] || range(8), lambda c, i: "
        "xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) r(b))"
    )
    points = "list_transform(string_split(doc_id || ':' || run, ''), lambda c: CAST(ord(c) AS BIGINT))"
    # Two bytes for a code point from 192 to 255.
    sent = f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [195, p - 64] END))"
    crc = f"xor(list_reduce([4294967295] || {sent}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    cut = "substring({0}, 1, k - 1) || substring({0}, k + 1)"
    return f"""WITH RECURSIVE crc AS MATERIALIZED ({table}),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '{letters}')), '{upper}', '{lower}') AS run FROM documents),
each AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
hashed AS MATERIALIZED (SELECT run, n, {crc} AS h, {crc} % length(run) + 1 AS k FROM each, crc),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN {cut.format('run')} ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS MATERIALIZED (SELECT word, n, k, {cut.format('word')} AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
near AS MATERIALIZED (SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n,
  CASE WHEN b.top >= 10 * w.n THEN (SELECT min(x.near) FROM near x WHERE x.word = w.word AND x.n = b.top) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word),
up AS (SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT up.word, f.form, step + 1 FROM up JOIN forms f ON f.word = up.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, (SELECT arg_max(u.root, u.step) FROM up u WHERE u.word = f.word) AS root, f.n, f.n_near, f.form_n FROM forms f"""
