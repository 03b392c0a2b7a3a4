"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are filed in buckets of near equal length. A query's k-th best product within the longest
bucket is a threshold it must reach; a bucket whose longest vector times the query's length stays
below it is never visited. Within a bucket the threshold becomes a bound on the cosine. Where it is
high, coordinates prune: by the query's largest coordinates, a vector whose coordinate lies outside the
range that the bound leaves cannot reach it. Where it is low, lengths prune: the bucket, longest
first, is cut where length times length falls below the threshold. What is left is verified by
products.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstar.llm.shared import staged
from cellstar.llm.vectors import matrix, numbered, usable

#: Candidates of a bucket, and queries of a block.
BUCKET, BLOCK = 4096, 1024
#: Steps of length to a doubling; cosine bound from which coordinates prune, and how many of them.
STEPS, COORDINATES_FROM, COORDINATES = 16, 0.6, 4
_NONE = -(2**63)
#: Up to this sum of absolute products a score is added up in longs.
SAFE = 2**62


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products: in floating point where that is exact; beyond a long, the long nearest to them."""
    bound = float(np.abs(queries.astype(np.float64)).max(initial=0)) * float(np.abs(vectors.astype(np.float64)).max(initial=0))
    bound *= vectors.shape[1]
    if bound < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    out = queries @ vectors.T  # wraps around, and is right wherever the sum itself is a long
    if bound >= SAFE:
        # The sum of absolute products bounds the score; only pairs for which that may be too much are added up again.
        most = np.abs(queries.astype(np.float64)) @ np.abs(vectors.astype(np.float64)).T
        for q, v in zip(*np.nonzero(most >= SAFE), strict=True):
            score = sum(map(mul, queries[q].tolist(), vectors[v].tolist()))
            out[q, v] = min(max(score, -(2**63)), 2**63 - 1)
    return out


def best_of_bucket(
    queries: np.ndarray, query_nodes: np.ndarray, least: np.ndarray, vectors: np.ndarray, nodes: np.ndarray,
    ids: np.ndarray, k: int,
) -> list[tuple[int, int, int]]:
    """(query position, vector position, score) of each query's k best of at least its threshold."""
    length = np.linalg.norm(vectors.astype(np.float64), axis=1)
    order = np.lexsort((ids, -length))
    vectors, nodes, ids, length = vectors[order], nodes[order], ids[order], length[order]
    unit = vectors / np.maximum(length, 1e-300)[:, None]
    size = np.linalg.norm(queries.astype(np.float64), axis=1)
    out: list[tuple[int, int, int]] = []

    def keep(q: int, at: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= least[q]) & (nodes[at] != query_nodes[q])
        at, scores = at[good], scores[good]
        if len(at) > k:  # all that tie with the k-th stay until ids decide
            top = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            at, scores = at[top], scores[top]
            first = np.lexsort((ids[at], -scores))[:k]
            at, scores = at[first], scores[first]
        out.extend((q, int(order[v]), int(s)) for v, s in zip(at, scores, strict=True))

    bound = least / np.maximum(size * length[0], 1e-300) if len(length) else least
    by_length = []
    for q in range(len(queries)):
        if least[q] > 0 and bound[q] > 1 + 1e-9:
            continue
        if least[q] > 0 and size[q] > 0 and bound[q] >= COORDINATES_FROM:
            cosine = min(1.0, float(bound[q])) - 1e-9
            mine = queries[q] / size[q]
            inside = np.ones(len(unit), bool)
            for f in np.argsort(-np.abs(mine))[:COORDINATES]:
                room = np.sqrt(max(0.0, (1 - cosine**2) * (1 - mine[f] ** 2))) + 1e-9
                inside &= np.abs(unit[:, f] - mine[f] * cosine) <= room if abs(mine[f]) < cosine else (
                    unit[:, f] * np.sign(mine[f]) >= abs(mine[f]) * cosine - room
                )
            at = np.flatnonzero(inside)
            keep(q, at, products(queries[q : q + 1], vectors[at])[0])
        else:
            by_length.append(q)
    for part in range(0, len(by_length), 256):
        block = np.array(by_length[part : part + 256])
        scores = products(queries[block], vectors)
        for q, row in zip(block, scores, strict=True):
            reach = len(length)
            if least[q] > 0 and size[q] > 0:
                reach = int(np.searchsorted(-length, -(least[q] / size[q]) * (1 - 1e-9), "right"))
            keep(int(q), np.arange(reach), row[:reach])
    return out


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """(query, query_id, score, id, node): per query and bucket at most k. ``pairs`` has both kinds of rows by key."""
    def run(table: pa.Table) -> pa.Table:
        ask = table.column("least").is_valid().to_numpy()
        table_q, table_v = table.filter(pa.array(ask)), table.filter(pa.array(~ask))
        if not len(table_q) or not len(table_v):
            found = []
        else:
            null_last = table_v.column("id").fill_null(2**63 - 1).to_numpy()
            found = best_of_bucket(
                matrix(table_q, "v", np.int64), table_q.column("node").to_numpy(), table_q.column("least").to_numpy(),
                matrix(table_v, "v", np.int64), table_v.column("node").to_numpy(), null_last, k,
            )
        q = pa.array([f[0] for f in found], pa.int64())
        v = pa.array([f[1] for f in found], pa.int64())
        return pa.table({
            "query": table_q.column("node").take(q), "query_id": table_q.column("id").take(q), "score": pa.array([f[2] for f in found], pa.int64()),
            "id": table_v.column("id").take(v), "node": table_v.column("node").take(v),
        })

    return pairs.groupBy("bucket", "block").applyInArrow(run, "query bigint, query_id bigint, score bigint, id bigint, node bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "node")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    table: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): for rows whose id is divisible by ``every``, the k best other rows.

    Components become floor(scale * x). Ties go to the smaller id, null last. Vectors that are null, empty
    or hold a null or non-finite component take no part; vectors of different lengths do not meet.
    Repeated rows are candidates (and queries) of their own. A component or score beyond a long counts as the
    long nearest to it.
    """
    doubles = F.col(f"`{vector_column}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_column}`").cast("long").alias("id"), doubles.alias("x")).where(usable(F.col("x")))
    whole = rows.select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    step = F.when(square > 0, F.floor(F.log2(square) / 2 * STEPS)).otherwise(F.lit(-1)).cast("long")
    named = staged(numbered(whole.select("id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("length"), step.alias("step"))))
    sizes = named.groupBy("dim", "step").agg(F.ceil(F.count("*") / BUCKET).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    filed = staged(named.join(sizes, ["dim", "step"]).withColumn("bucket", F.concat_ws(":", "dim", "step", part)).drop("parts"))
    asking = filed.where(F.col("id") % every == 0)
    blocks = asking.agg(F.ceil(F.count("*") / BLOCK)).first()[0]
    if not blocks:
        return filed.limit(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score"))
    asking = asking.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)))
    buckets = staged(filed.groupBy("dim", "bucket").agg(F.max("length").alias("longest"), F.count("*").alias("n")))
    # The first visit: of each dimension the longest bucket with enough in it, else the fullest.
    enough = F.struct((F.col("n") > k).alias("enough"), F.when(F.col("n") > k, F.col("longest")).otherwise(F.col("n")).alias("by"), "bucket")
    first = buckets.groupBy("dim").agg(F.max(enough)["bucket"].alias("seed"))

    def visits(queries: DataFrame) -> DataFrame:
        """Rows of queries and of the buckets they visit, by bucket and block."""
        met = queries.select("bucket", "block").distinct()
        columns = ["bucket", "block", "id", "node", "v"]
        held = filed.select("bucket", "id", "node", "v").join(met, "bucket").select(*columns, F.lit(None).cast("long").alias("least"))
        return queries.select(*columns, "least").unionAll(held)

    seeds = asking.drop("bucket").join(first, "dim").withColumnRenamed("seed", "bucket").withColumn("least", F.lit(_NONE).cast("long"))
    early = staged(_search(visits(seeds), k))
    # What a query already has k of, it must reach elsewhere too.
    reached = _best(early, k).groupBy("query").agg(F.count("*").alias("c"), F.min("score").alias("s"))
    reached = reached.select(F.col("query").alias("node"), F.when(F.col("c") >= k, F.col("s")).alias("s"))
    open_ = asking.drop("bucket").join(reached, "node", "left").withColumn("least", F.coalesce("s", F.lit(_NONE).cast("long"))).drop("s")
    others = buckets.join(first, "dim").where("bucket <> seed").select("dim", "bucket", "longest")
    can = (F.col("least") <= 0) | (F.col("length") * F.col("longest") * (1 + 1e-9) >= F.col("least"))
    late = _search(visits(staged(open_.join(others, "dim").where(can))), k)
    return _best(early.unionAll(late), k).select("query_id", "rank", "id", "score")
