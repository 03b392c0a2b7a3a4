"""SimHash near-duplicates: fingerprints of word shingles, linked by few differing bits.

Two fingerprints that differ in at most ``radius`` bits differ in at most ``t_i`` bits of some
group ``i`` of the bits whenever the thresholds ``t_i`` (-1: the group is not probed) add up to
``radius - groups + 1``. Bits that go together are put into one group, and the thresholds are
chosen by dynamic programming over the candidates each group would bring. A fingerprint probes
the groups so chosen, and the members of a bucket are verified over all 64 bits.

A bucket too large for one task is not cut: its members agree on the bits of its group, so two
of them within the radius agree exactly on one of ``radius + 1`` parts of the other bits. It is
dealt again by those parts until it is small, or until so few bits are free that it must be.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstar.llm.shared import by_place, connected_components, slices, staged

BITS = 64
SEED = 42
#: Largest bucket that one task verifies, and how few free bits bound a bucket by themselves.
BUCKET = 512
FEW_BITS = 9


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of the ASCII-lower-cased words' shingles; zero without a word."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = min(shingle, len(words))
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[i : j - 1], SEED) for i, j in zip(starts, starts[size:], strict=False)),
        np.uint64, len(words) - size + 1,
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp) of every row; a null text has no words. ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["id", "fp"]
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp bigint")


def fingerprinted(docs: DataFrame, shingle: int, name: str, text_column: str = "text") -> DataFrame:
    """``docs`` with the fingerprint as column ``name``."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([*batch.columns, pa.array(prints)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, docs.limit(0).withColumn(name, F.lit(0).cast("long")).schema)


def bit_counts(prints: DataFrame) -> np.ndarray:
    """How often bits i and j are both set, over all rows: 64 x 64 sums made in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        flat = total.ravel().astype(np.int64)
        yield pa.record_batch([pa.array(np.arange(BITS * BITS)), pa.array(flat)], names=["at", "n"])

    sums = prints.select("fp").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    counts = np.zeros(BITS * BITS)
    for at, n in sums.collect():  # 64 x 64 numbers whatever the rows
        counts[at] = n
    return counts.reshape(BITS, BITS)


def bit_groups(counts: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """The 64 bits in ``groups`` groups of near equal size; correlated bits share a group."""
    share = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    strength = np.abs((counts / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, out = set(range(BITS)), []
    for g in range(groups):
        width = BITS // groups + (g < BITS % groups)
        rest = sorted(free)
        group = [max(rest, key=lambda b: strength[b, rest].sum())]
        while len(group) < width:
            rest = sorted(free - set(group))
            group.append(max(rest, key=lambda b: strength[b, group].sum()))
        free -= set(group)
        out.append(sorted(group))
    return out


def allocate(costs: list[list[float]], radius: int) -> list[int]:
    """Thresholds of least total cost that add up to radius - groups + 1; costs[i][t + 1] is group i's."""
    least: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in least.items():
            for t in range(-1, radius + 1):
                way = (cost + options[t + 1], [*chosen, t])
                if spent + t not in step or way < step[spent + t]:
                    step[spent + t] = way
        least = step
    return least[radius - len(costs) + 1][1]


def _mask(bits: list[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def thresholds(prints: DataFrame, n: int, counts: np.ndarray, groups: list[list[int]], radius: int) -> list[int]:
    """Allocation by candidates: exact for threshold 0, carried on to others by the bits' shares."""
    share = np.diag(counts) / n
    differ = 2 * share * (1 - share)
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("v")) for i, g in enumerate(groups)
    ]))
    sizes = prints.select(keys.alias("k")).groupBy("k").count()
    pairs = sizes.groupBy("k.g").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("c"))
    exact = dict(pairs.collect())
    costs = []
    for i, group in enumerate(groups):
        far = np.array([1.0])
        for b in group:
            far = np.convolve(far, [1 - differ[b], differ[b]])
        near = np.cumsum(far)[: radius + 1]
        probes = np.cumsum([len(list(combinations(group, t))) for t in range(radius + 1)])
        costs.append([0.0, *(exact.get(i, 0.0) * near / max(near[0], 1e-300) + n * probes)])
    return allocate(costs, radius)


def probes(prints: DataFrame, groups: list[list[int]], allowed: list[int]) -> DataFrame:
    """(path, key, fp): a fingerprint under every value within the threshold of its own, per probed group."""
    keys = []
    for i, (group, t) in enumerate(zip(groups, allowed, strict=True)):
        own = F.col("fp").bitwiseAND(F.lit(_mask(group)))
        flips = [_mask(list(c)) for k in range(t + 1) for c in combinations(group, k)]
        keys += [F.struct(F.lit(str(i)).alias("path"), own.bitwiseXOR(F.lit(f)).alias("key")) for f in flips]
    return prints.select("fp", F.inline(F.array(*keys))).select("path", "key", "fp")


def verify(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b) links of the members of each (path, key): each member with the smallest it is connected to there."""

    def linked(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = [], []
        at = np.arange(len(fp))
        for far in range(1, len(fp)):
            at = at[at < len(fp) - far]
            at = at[group[at] == group[at + far]]
            if not len(at):
                break
            close = at[np.bitwise_count((fp[at] ^ fp[at + far]).view(np.uint64)) <= radius]
            left.append(close)
            right.append(close + far)
        low = np.arange(len(fp))
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            while True:
                least = np.minimum(low[a], low[b])
                new = low.copy()
                np.minimum.at(new, a, least)
                np.minimum.at(new, b, least)
                if (new == low).all():
                    break
                low = new
        moved = np.flatnonzero(low != np.arange(len(fp)))
        return fp[moved], fp[low[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.array([], np.int64), np.array([], np.int64))

        def out(group: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = linked(group, fp)
            return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            group, fp = (np.concatenate([r, batch.column(i).to_numpy(zero_copy_only=False)]) for i, r in enumerate(rest))
            if len(group):
                last = np.flatnonzero(group != group[-1])
                cut = last[-1] + 1 if len(last) else 0
                yield out(group[:cut], fp[:cut])
                rest = group[cut:], fp[cut:]
        yield out(*rest)

    # The 64-bit digest of a bucket's name only keeps its rows together: members that share it by chance
    # are verified like any others.
    named = rows.select(F.xxhash64("path", "key").alias("bucket"), "fp")
    return named.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a bigint, b bigint")


def near_links(prints: DataFrame, radius: int, groups: int = 4, bucket: int = BUCKET) -> DataFrame | None:
    """(a, b) links that connect all distinct fingerprints within ``radius``; None if there are none to compare.

    ``prints`` has one row per distinct fingerprint (fp).
    """
    n = prints.count()
    if n < 2:
        return None
    counts = bit_counts(prints)
    split = bit_groups(counts, n, groups)
    allowed = thresholds(prints, n, counts, split, radius)
    rows = probes(prints, split, allowed)
    free = {str(i): sorted(set(range(BITS)) - set(g)) for i, g in enumerate(split)}
    links = []
    while True:
        sizes = rows.groupBy("path", "key").count()
        large = staged(sizes.where(F.col("count") > bucket).select("path", "key"))
        open_paths = {r[0] for r in large.select("path").distinct().collect() if len(free[r[0]]) > FEW_BITS}
        if not open_paths:
            return staged(_union([*links, verify(rows, radius)]))
        again = large.where(F.col("path").isin(*open_paths))
        links.append(verify(rows.join(again, ["path", "key"], "left_anti"), radius))
        parts = {p: [free[p][k :: radius + 1] for k in range(radius + 1)] for p in open_paths}
        inner = F.create_map(*[x for p, own in parts.items() for x in (
            F.lit(p),
            F.array(*[F.struct(F.lit(f"{p}.{k}").alias("path"), F.lit(_mask(b)).alias("mask")) for k, b in enumerate(own)]),
        )])
        # A key says which bucket the row came from, and what it has in the part that all there must share.
        dealt = rows.join(again, ["path", "key"]).select("key", "fp", F.inline(inner[F.col("path")]))
        rows = staged(dealt.select("path", F.xxhash64("key", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp"))
        free = {f"{p}.{k}": sorted(set(free[p]) - set(b)) for p, own in parts.items() for k, b in enumerate(own)}


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionAll(t)
    return out


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fp, component, root) of every row of ``docs``: fingerprint and smallest id reachable by links.

    ``root`` is a fingerprint that stands for the component, whatever the ids.

    Rows without words (null, empty, blank) have fingerprint zero and link like any other. Repeated rows
    link to each other. Among null ids the others' smallest counts; where there is none it is null.
    An empty table gives an empty one.
    """
    prints = staged(fingerprints(docs, shingle, id_column, text_column))
    each = staged(prints.groupBy("fp").agg(F.min("id").alias("id")))
    links = near_links(each.select("fp"), radius)
    if links is None:
        classes = each.select("fp", F.col("id").alias("component"), F.col("fp").alias("root"))
        return prints.join(classes, "fp").select("id", "fp", "component", "root")
    roots = connected_components(links, "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = each.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("id").alias("component"))
    classes = staged(rooted.join(first, "root").select("fp", "component", "root"))
    return prints.join(classes, "fp").select("id", "fp", "component", "root")


def one_of_each(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one of smallest id (null last), then fingerprint.

    Of rows equal in both, any one stays. Other columns may have any name.
    """
    rows = near_duplicates(docs, shingle, radius, id_column, text_column)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "fp"))
    kept = rows.groupBy("root").agg(first.alias("f")).select("f.id", "f.fp")
    doc_id, text = (f"c{docs.columns.index(c)}" for c in (id_column, text_column))
    marked = fingerprinted(by_place(docs), shingle, "print", text)
    same = F.col(doc_id).eqNullSafe(F.col("id")) & (F.col("print") == F.col("fp"))
    return marked.join(kept, same, "left_semi").dropDuplicates([doc_id, "print"]).drop("print").toDF(*docs.columns)


def hex_print(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
