"""Near-duplicate vectors: int8 tile products with error bounds, verified in double precision.

Equal vectors are one node. Nodes are dealt into tiles of bounded size; every pair of tiles whose
caps (mean direction and largest angle to it) could hold a pair above the threshold is multiplied.
A unit vector a is s*q + e with int8 components q; the product of two is s*t*(q.r) within
|s*q|*|f| + |e|, both known, so a pair whose int8 product is more than that below the threshold is
out for certain. Only the others are recomputed in double precision.

A task holds two tiles. It returns a row per node with a link, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.shared import connected_components, staged
from cellstar.llm.vectors import matrix, narrow, numbered, usable

#: Nodes of a tile, and rows of it that are multiplied at once.
TILE, STRIP = 4096, 1024
#: Vectors that the cells' centres are drawn from, at most, and the most cells.
SAMPLE, CELLS = 20_000, 256
SLACK = 1e-6


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q, scale, length of s*q, length of the error) of unit vectors."""
    scale = np.maximum(np.abs(unit).max(1), 1e-300) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return q, scale, np.linalg.norm(near, axis=1), np.linalg.norm(unit - near, axis=1)


def levelled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that their largest components are near 1: squares neither overflow nor
    vanish, and no digit changes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with cosine(a[i], b[j]) >= threshold; only i < j if both are the same tile."""
    a, b = levelled(a), levelled(b)
    a_length, b_length = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    q, s, size, wrong = quantised(a / a_length[:, None])
    r, t, _, off = quantised(b / b_length[:, None])
    # Integer products in floating point: exact, as no sum reaches the type's limit.
    kind = np.float32 if 127 * 127 * a.shape[1] < 1 << 24 else np.float64
    left, right = q.astype(kind), r.astype(kind).T
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(a), STRIP):
        part = slice(at, at + STRIP)
        least = threshold - SLACK - size[part] * off.max() - wrong[part]
        product = left[part] @ right
        rough = least / (s[part] * np.where(least > 0, t.max(), t.min()))
        i, j = np.nonzero(product >= (rough * (1 - np.sign(rough) * SLACK))[:, None].astype(kind))
        if same:
            i, j = i[i + at < j], j[i + at < j]
        value = product[i, j] * s[i + at] * t[j]
        near = value >= threshold - SLACK - size[i + at] * off[j] - wrong[i + at]
        i, j = i[near] + at, j[near]
        for k in range(0, len(i), 1 << 16):
            x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            cosine = np.einsum("ij,ij->i", a[x], b[y]) / (a_length[x] * b_length[y])
            found.append((x[cosine >= threshold], y[cosine >= threshold]))
    if not found:
        return np.array([], np.int64), np.array([], np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    low = np.arange(n)
    while True:
        least = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        if (new == low).all():
            return low
        low = new


def _tiles(nodes: DataFrame, n: int, size: int) -> DataFrame:
    """``nodes`` with tile: cells around sampled centres, a large cell in parts by hash."""
    cells = int(min(CELLS, np.ceil(n / size)))
    rank = F.xxhash64("node")
    sample = nodes.where(rank <= min(2**63 - 1, int(-(2**63) + min(1.0, SAMPLE / n) * 2**64))).select("vector").limit(SAMPLE)
    points = levelled(matrix(sample.toArrow(), "vector", np.float64))
    points = points / np.linalg.norm(points, axis=1, keepdims=True)
    centres = points[np.random.default_rng(5).permutation(len(points))[:cells]]
    for _ in range(5):
        nearest = (points @ centres.T).argmax(1)
        sums = np.array([points[nearest == c].sum(0) for c in range(len(centres))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            unit = levelled(matrix(table, "vector", np.float64)) if len(table) else np.zeros((0, centres.shape[1]))
            cell = (unit @ centres.T).argmax(1) if len(unit) else np.array([], np.int64)
            yield batch.append_column("cell", pa.array(cell.astype(np.int64)))

    celled = staged(nodes.mapInArrow(run, nodes.limit(0).withColumn("cell", F.lit(0).cast("long")).schema))
    parts = celled.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    counts = sorted((r.cell, r.parts) for r in parts.collect())  # at most CELLS rows
    first = dict(zip([c for c, _ in counts], np.cumsum([0, *[p for _, p in counts]]).tolist(), strict=False))
    start = F.create_map(*[F.lit(x) for c, k in counts for x in (c, first[c])])
    many = F.create_map(*[F.lit(x) for c, k in counts for x in (c, k)])
    return celled.withColumn("tile", (start[F.col("cell")] + F.pmod(F.xxhash64("node"), many[F.col("cell")])).cast("int"))


def _caps(table: pa.Table) -> pa.Table:
    unit = levelled(matrix(table, "vector", np.float64))
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    centre = unit.sum(0)
    length = np.linalg.norm(centre)
    centre = centre / length if length > 1e-9 else unit[0]
    angle = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
    return pa.table({"tile": table.column("tile").slice(0, 1), "centre": pa.array([centre], pa.list_(pa.float64())), "angle": pa.array([angle])})


def linked_nodes(nodes: DataFrame, threshold: float, size: int = TILE) -> DataFrame:
    """(node, n, label) per pair of tiles: copies linked to the node there, and a node it is connected to."""
    n = nodes.count()
    tiled = staged(_tiles(nodes, n, size))
    caps = staged(tiled.select("tile", "vector").groupBy("tile").applyInArrow(_caps, "tile int, centre array<double>, angle double"))
    last = caps.agg(F.max("tile")).first()[0]
    # A row per pair of tiles, not of vectors.
    first = caps.select("tile", "centre", "angle", F.explode(F.sequence("tile", F.lit(last))).alias("other"))
    second = caps.select(F.col("tile").alias("other"), F.col("centre").alias("c"), F.col("angle").alias("g"))
    dot = F.aggregate(F.zip_with("centre", "c", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))) - F.col("angle") - F.col("g")
    pairs = first.join(second, "other").where(F.isnan(apart) | (apart <= float(np.arccos(threshold)) + SLACK)).select("tile", "other")
    ends = F.array(F.struct(F.col("tile").alias("t"), F.lit(0).alias("side")), F.struct(F.col("other").alias("t"), F.lit(1).alias("side")))
    sides = pairs.select("tile", "other", F.inline(ends)).where("side = 0 or tile <> other")
    dealt = tiled.select(F.col("tile").alias("t"), "node", "copies", "vector").join(sides, "t")

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        vectors = matrix(table, "vector", np.float64)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = table.column("tile")[0].as_py() == table.column("other")[0].as_py()
        two = one if same else two
        i, j = close_pairs(vectors[one], vectors[two], threshold, same) if len(one) and len(two) else (one[:0], two[:0])
        i, j = one[i], two[j]
        links = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
        has = np.flatnonzero(links)
        label = node[_least_labels(len(node), i, j)]
        return pa.table({"node": node[has], "n": links[has].astype(np.int64), "label": label[has]})

    return dealt.groupBy("tile", "other").applyInArrow(run, "node bigint, n bigint, label bigint")


def near_duplicates(
    table: DataFrame, threshold: float = 0.9, size: int = TILE, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(id, n_links, component, kept) of every row: links by cosine, smallest id connected by links, whether it is its own.

    A vector that is null, empty, zero or holds a null or non-finite component has no links, and is a
    component of its own; vectors of different lengths are not linked. Repeated rows and equal vectors
    link to each other. Null ids are passed over for the component; a component of nulls has null, and
    kept is false.
    """
    vector = narrow(table, vector_column)
    rows = staged(numbered(table.select(F.col(f"`{id_column}`").alias("id"), vector.alias("vector"))).withColumnRenamed("node", "row"))
    good = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    nodes = staged(rows.where(good).groupBy("vector").agg(F.count("*").alias("copies"), F.min("row").alias("node"), F.min("id").alias("least")))
    lengths = [r[0] for r in nodes.select(F.size("vector")).distinct().collect()]  # one, but for a mixed table
    found = None
    for length in sorted(lengths):
        own = linked_nodes(nodes.where(F.size("vector") == length).select("node", "copies", "vector"), threshold, size)
        found = own if found is None else found.unionAll(own)
    if found is None:
        alone = F.col("id").isNotNull()
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"), alone.alias("kept"))
    found = staged(found)
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select("node", "label"), "node", "label").select("node", F.col("component").alias("root"))
    each = nodes.select("node", "vector", "copies", "least").join(counts, "node", "left").join(roots, "node", "left")
    each = staged(each.withColumn("root", F.coalesce("root", "node")).withColumn("n", F.coalesce("n", F.lit(0)) + F.col("copies") - 1))
    first = each.groupBy("root").agg(F.min("least").alias("component"))
    classes = each.join(first, "root").select(F.col("vector").alias("v"), "n", "component")
    joined = rows.where(good).join(classes, F.col("vector") == F.col("v")).select("id", F.col("n").alias("n_links"), "component")
    rest = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(False))
    return joined.unionAll(rest).withColumn("kept", kept)
