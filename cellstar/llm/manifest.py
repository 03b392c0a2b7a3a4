"""Merkle dataset manifest: a tree of digests for each group of rows, and one tree over the groups.

Rows of a tree are ranked, and every node carries the interval of leaf ranks that it covers, so the
intervals are nested. A level is built from the one below by grouping on the bucket of the interval's
start; ancestors are attached from the root down by joining a level to the one above on that bucket,
with containment of the intervals. A parent carries its run of children; the siblings of a child are what is left of
the parent's interval without its own. Rows meet in runs of ``FANOUT`` only: no tree, however large,
passes through one task. Ranks come from a range partitioning and the partitions' counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellstar.llm.shared import staged

#: Children of a node.
FANOUT = 16
#: The bits of a place below the partition's number, as monotonically_increasing_id makes it.
_WITHIN = 33
_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """Hex SHA-256 of the fields, each as its UTF-8 byte count, a colon and its text, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]), 256)


def _ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``lo``, their rank within the tree by key and digest, and ``n``, the tree's leaves."""
    dealt = leaves.repartitionByRange("tree", "key", "digest", F.monotonically_increasing_id())
    placed = staged(
        dealt.sortWithinPartitions("tree", "key", "digest").withColumn("place", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("place", _WITHIN))
    spots = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("here"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spots = spots.select(
        "tree", "part", "first", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"),
        F.sum("here").over(of_tree).alias("n"),
    )
    lo = F.col("place") - F.col("first") + F.col("before")
    return placed.join(spots, ["tree", "part"]).select(*leaves.columns, lo.alias("lo"), "n")


def _grow(leaves: DataFrame) -> list[DataFrame]:
    """The levels of all trees, leaves first: (tree, lo, hi, n, digest[, children]) of every node.

    A tree has nodes up to the level on which one is left.
    """
    levels = [staged(_ranked(leaves).withColumn("hi", F.col("lo") + 1))]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    width = 1
    while most > width:
        run = F.struct("lo", "hi", "digest")
        nodes = levels[-1].where(F.col("n") > width)
        width *= FANOUT
        nodes = nodes.groupBy("tree", F.floor(F.col("lo") / width).alias("bucket")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n"),
            F.sort_array(F.collect_list(run)).alias("children"),
        )
        digest = F.sha2(F.array_join("children.digest", ""), 256)
        levels.append(staged(nodes.select("tree", "lo", "hi", "n", digest.alias("digest"), "children")))
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the last node of every tree."""
    lasts = [nodes.where(F.col("n") <= FANOUT**k).select("tree", "digest") for k, nodes in enumerate(levels)]
    return reduce(DataFrame.unionAll, lasts)


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Every leaf with ``path``, its siblings from its own run up, and the columns of its tree's row in ``tops``.

    ``tops`` has (tree, path, ...): the path of the tree's root, above the tree.
    """
    given = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for k in reversed(range(len(levels))):
        nodes, width = levels[k], FANOUT ** (k + 1)
        own = [c for c in nodes.columns if c != "tree"]
        found = nodes.where(F.col("n") <= FANOUT**k).join(tops, "tree").select("tree", *own, "path", *given)
        if above is not None:
            up = above.select(
                "tree", F.floor(F.col("lo") / width).alias("bucket"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"),
                F.col("children").alias("run"), F.col("path").alias("up_path"), *given,
            )
            down = nodes.where(F.col("n") > FANOUT**k).withColumn("bucket", F.floor(F.col("lo") / width))
            inside = down.join(up, ["tree", "bucket"]).where("up_lo <= lo AND hi <= up_hi")
            left = F.filter("run", lambda x: x["hi"] <= F.col("lo"))
            right = F.filter("run", lambda x: x["lo"] >= F.col("hi"))
            level = F.struct(
                F.array_join(F.transform(left, lambda x: x["digest"]), "").alias("left"),
                F.array_join(F.transform(right, lambda x: x["digest"]), "").alias("right"),
            )
            path = F.concat(F.array(level), "up_path").alias("path")
            found = found.unionByName(inside.select("tree", *own, path, *given))
        above = staged(found) if k else found
    return above


def manifest(docs: DataFrame, fields: list[str], id_column: str = "doc_id", group_column: str = "source", tampered: Column | None = None) -> DataFrame:
    """(id, leaf, presented, subroot, root, path) of every row.

    A leaf is the digest of ``fields``; leaves of a group ascend by id (null first), rows of one id by leaf, so
    that equal rows are interchangeable and repeated ones stay. Groups ascend by the bytes of their text, null
    first, and have one tree of their own whose leaves are the groups' roots. ``path`` holds, from the
    leaf's run to the root, the digests left and right of the way, each side joined to one text; levels
    on which one node is left add none. ``presented`` is ``tampered`` (a column over ``docs``: a digest shown in place of
    the leaf), or the leaf where that is null. An empty table has no rows and no root. Other columns are not read.
    """
    given = lambda c: F.col(f"`{c}`")
    # Text of a group: null, written so that it comes first.
    tree = F.coalesce(F.concat(F.lit("="), given(group_column).cast("string")), F.lit("-"))
    shown = F.lit(None).cast("string") if tampered is None else tampered
    leaves = docs.select(tree.alias("tree"), given(id_column).alias("key"), leaf_digest([given(f) for f in fields]).alias("digest"), shown.alias("shown"))
    levels = _grow(leaves)
    groups = staged(_roots(levels))
    over = _grow(groups.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest"))
    root = _roots(over).select("tree", F.lit(None).cast(_PATH).alias("none"), F.col("digest").alias("root"))
    root = root.select("tree", F.coalesce("none", F.array().cast(_PATH)).alias("path"), "root")
    tops = _descend(over, root).select(F.col("key").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return _descend(levels, staged(tops)).select(
        F.col("key").alias("id"), F.col("digest").alias("leaf"), F.coalesce("shown", "digest").alias("presented"),
        "subroot", "root", "path",
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on the way, from the leaf's run to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from ``leaf`` and the siblings on its way."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def oracle(levels: int = 6) -> str:
    """DuckDB SQL of op11_manifest, for trees of up to ``FANOUT ** levels`` leaves."""
    crc_table = (
        "SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce([b] || range(8), lambda c, i: "
        "xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) r(b))"
    )
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))"
    crc = f"xor(list_reduce([4294967295] || {digits}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def leaf(text: str) -> str:
        fields = ("doc_id", "source", "lang", "n_chars", text)
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"

    parts = [
        f"crc AS MATERIALIZED ({crc_table})",
        f"leaves AS MATERIALIZED (SELECT doc_id, source, {leaf('text')} AS leaf, "
        f"CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS shown FROM documents, crc)",
        "s0 AS MATERIALIZED (SELECT source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
        "leaf AS d, count(*) OVER (PARTITION BY source) AS n, doc_id, shown FROM leaves)",
    ]

    def grow(name: str) -> None:
        for k in range(levels):
            parts.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT tree, i // {FANOUT} AS i, CASE WHEN n = 1 THEN min(d) ELSE "
                f"sha256(string_agg(d, '' ORDER BY i)) END AS d, (n + {FANOUT - 1}) // {FANOUT} AS n FROM {name}{k} GROUP BY tree, i // {FANOUT}, n)"
            )

    def walk(name: str, rows: str, at: str) -> str:
        """Joins the levels of ``name`` to ``rows``, whose place in the leaves is ``at``."""
        for k in range(levels):
            run = f"PARTITION BY tree, i // {FANOUT} ORDER BY i ROWS BETWEEN"
            parts.append(
                f"{name}w{k} AS MATERIALIZED (SELECT tree, i, n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
            )
            parts.append(
                f"{name}p{k} AS MATERIALIZED (SELECT p.* EXCLUDE (proof, f), CASE WHEN w.n = 1 THEN p.proof ELSE p.proof || w.l || w.r END AS proof, "
                f"CASE WHEN w.n = 1 THEN p.f ELSE sha256(w.l || p.f || w.r) END AS f FROM {rows} p JOIN {name}w{k} w "
                f"ON w.tree IS NOT DISTINCT FROM p.{at}tree AND w.i = p.{at}i // {FANOUT**k})"
            )
            rows = f"{name}p{k}"
        return rows

    grow("s")
    parts.append(
        f"t0 AS MATERIALIZED (SELECT 0 AS tree, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS i, d, "
        f"count(*) OVER () AS n, tree AS source FROM s{levels})"
    )
    grow("t")
    parts.append(
        "start AS MATERIALIZED (SELECT s.doc_id, s.d AS leaf, s.tree AS s_tree, s.i AS s_i, t.tree AS t_tree, t.i AS t_i, t.d AS subroot, "
        "'' AS proof, s.shown AS f FROM s0 s JOIN t0 t ON t.source IS NOT DISTINCT FROM s.tree)"
    )
    rows = walk("t", walk("s", "start", "s_"), "t_")
    return (
        f"WITH {', '.join(parts)} SELECT p.doc_id, p.leaf, p.subroot, t.d AS root, sha256(p.proof) AS proof_sha256, p.f AS folded_root, "
        f"p.f = t.d AS verified FROM {rows} p, t{levels} t"
    )
