"""Mixing sources to target weights, in shards that each hold an exact share of every source.

A source's documents are put in a fixed order by the MD5 of their ids (of their texts, where they have
none) and cut into 4096 blocks of that order. Its target becomes whole passes over the source and a last pass over its first blocks.
The block quotas of all sources are then split among the output shards by a tree: at each node the
blocks that go left are one multivariate hypergeometric draw from the node's quotas, so that every
shard gets its exact number of blocks and every source gives exactly its quota. Each shard draws its
blocks from its own stretch of a permuted block order, new for each pass, and its rows get a random local order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellstar.llm.shared import WORD, by_place, staged

BLOCKS = 4096
#: Words that a shard should hold; there are as many shards as that takes.
SHARD_WORDS = 2_000_000
WEIGHTS = (5, 2, 1)


def words(text: Column) -> Column:
    """Number of words, as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Weights are dealt in code point order, null last. Sources in order of how soon they reach their
    limit are filled until the level of the rest leaves the next one below its own. The windows see
    one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.select(
        "source", "source_size", place.alias("place"), weight.cast("double").alias("weight"),
        (F.col("source_size") * most).alias("limit"),
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    level = (
        (F.sum("source_size").over(Window.partitionBy()) * share
         - F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    )
    rows = rows.withColumn("level", level)
    open_level = F.when(F.col("limit") > F.col("weight") * F.col("level"), F.col("level"))
    last = F.max(open_level).over(Window.partitionBy())
    return rows.select(
        "source", "source_size", F.coalesce(F.least("limit", F.col("weight") * last), "limit").alias("target")
    )


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """shards x sources: how many of each source's blocks a shard gets; rows differ by one block at most."""
    pick = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), np.int64)

    def part(first: int, count: int, have: np.ndarray) -> None:
        if count == 1 or not len(have):
            out[first] = have
            return
        left = count // 2
        total = int(have.sum())
        # Shares of all shards are cut from one line, so that sizes differ by one at most.
        go = total * left // count
        given = np.zeros_like(have)
        rest, need = total, go
        for i, n in enumerate(have):  # marginal by marginal: the draw stays exact at any size
            rest -= int(n)
            given[i] = _hypergeometric(pick, int(n), rest, need)
            need -= int(given[i])
        part(first, left, given)
        part(first + left, count - left, have - given)

    part(0, shards, np.array(quotas, np.int64))
    return out


def _hypergeometric(pick: np.random.Generator, good: int, bad: int, draws: int) -> int:
    if draws == 0 or good == 0:
        return 0
    return int(pick.hypergeometric(good, bad, draws)) if bad else draws


def _key(doc_id: Column, text: Column) -> Column:
    """What a document's place in its source goes by: its id, or its text where it has none."""
    return F.md5(F.coalesce(doc_id.cast("string"), text, F.lit("")))


def _block(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


def mix(
    docs: DataFrame, shards: int | None = None, seed: int = 7, cut: bool = True, weights: Sequence[int] = WEIGHTS,
    share: float = 1.5, most: float = 2.0, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source", name: str = "mixed",
) -> DataFrame:
    """``docs`` with a struct ``name``: size, source_size, target, taken, and draws (pass, shard, words).

    A document is drawn once per whole pass, and once more if the last pass reaches it. With ``cut`` the
    document at its end gives just the words still due, so that a source gives floor(target) words;
    without, it is drawn whole if at least half of it is due. Null and blank texts have no words and
    nothing to give. Repeated rows are documents of their own; those equal in id, words and text may
    stand for each other. Null is a source like any other. A column ``name`` is replaced; others may have any name.

    Without ``shards`` their number grows with the targets, at SHARD_WORDS words each. Beyond BLOCKS shards
    each of the tree's is dealt by a hash over equally many (so their number may be rounded up).
    The recipe (a row per source) passes through the driver; documents and blocks do not.
    """
    docs = docs.drop(name)
    rows = by_place(docs)
    doc_id, text, source = (F.col(f"c{docs.columns.index(c)}") for c in (id_column, text_column, source_column))
    key = _key(doc_id, text)
    placed = rows.select("*", source.alias("of"), key.alias("key"), _block(key).alias("block"))
    recipe, parts = _recipe(placed, text, shards, seed, weights, share, most)
    plan = docs.sparkSession.createDataFrame(recipe, _RECIPE)
    joined = placed.join(plan, F.col("of").eqNullSafe(F.col("source"))).withColumn("size", words(text))
    at_end = F.coalesce((F.col("block") == F.col("end")) & (_place(text) == F.col("stop")), F.lit(False))
    rest = joined.withColumn("copy", F.lit(0).cast("long"))
    if max(recipe["copies"].to_pylist(), default=0) > 1:
        tied = at_end & (F.col("copies") > 1)
        numbered = _numbered(joined.where(tied).select(*placed.columns))
        numbered = numbered.join(plan, F.col("of").eqNullSafe(F.col("source"))).withColumn("size", words(text))
        rest = rest.where(~tied).unionByName(numbered)
    due = F.greatest(F.lit(0).cast("long"), F.least("size", F.col("due") - F.col("copy") * F.col("size")))
    if not cut:
        due = F.when(due * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long"))
    before = (F.col("block") < F.col("end")) | (F.col("block") == F.col("end")) & (_place(text) < F.col("stop"))
    extra = F.when(before, F.col("size")).when(at_end, due).otherwise(F.lit(0).cast("long"))
    given = rest.withColumn("extra", extra)

    def draw(turn: int, taken: Column) -> Column:
        shard = F.get(F.get("shards", F.lit(turn)), F.col("block")).cast("int")
        if parts > 1:
            shard = shard * parts + F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), "key"), F.lit(parts)).cast("int")
        return F.when(taken > 0, F.struct(F.lit(turn).alias("pass"), shard.alias("shard"), taken.alias("words")))

    passes = [
        draw(t, F.when(F.col("passes") > t, F.col("size")).when(F.col("passes") == t, F.col("extra")))
        for t in range(int(np.ceil(most)) + 1)
    ]
    taken = F.col("passes") * F.col("size") + F.col("extra")
    mixed = F.struct("size", "source_size", "target", taken.alias("taken"), F.array_compact(F.array(*passes)).alias("draws"))
    return given.select(*rows.columns, mixed).toDF(*docs.columns, name)


def _place(text: Column) -> Column:
    """A document's place in its source; ``key`` and ``size`` are columns of its row."""
    return F.struct("key", "size", F.xxhash64(text).alias("mark"))


def _numbered(tied: DataFrame) -> DataFrame:
    """``tied`` with the number of each row among those of its source (copy), counted over partitions of a written table."""
    rows = staged(tied.withColumn("node", F.monotonically_increasing_id())).withColumn("part", F.shiftright("node", 33))
    counts = rows.groupBy("of", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("of").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    own = F.row_number().over(Window.partitionBy("of", "part").orderBy("node")) - 1
    rows = rows.withColumn("own", own).join(counts, F.col("of").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return rows.select(*tied.columns, (F.col("own") + F.col("ahead")).alias("copy"))


_RECIPE = (
    "source string, source_size long, target double, passes long, due long, end int, "
    "stop struct<key: string, size: long, mark: long>, copies long, shards array<array<smallint>>"
)


def _recipe(
    placed: DataFrame, text: Column, shards: int | None, seed: int, weights: Sequence[int], share: float, most: float
) -> tuple[pa.Table, int]:
    """A row per source: passes, the document at which the last one ends, and which shard draws each block; and
    over how many shards each of these is dealt."""
    sized = placed.select(F.col("of").alias("source"), "block", words(text).alias("size"))
    blocks = sized.groupBy("source", "block").agg(F.sum("size").alias("size"))
    sizes = blocks.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    want = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0))
    due = targets.withColumn("passes", passes).withColumn("due", want - F.col("passes") * F.col("source_size"))
    by = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    upto = blocks.withColumn("upto", F.sum("size").over(by)).select(F.col("source").alias("s"), "block", "size", "upto")
    end = (F.col("upto") >= F.col("due")) & (F.col("upto") - F.col("size") < F.col("due"))
    reach = due.select("source", "due").join(upto, F.col("source").eqNullSafe(F.col("s"))).where(end)
    reach = reach.groupBy(F.col("source").alias("s")).agg(F.min("block").alias("end"), F.min(F.col("upto") - F.col("size")).alias("before"))
    rows = due.join(reach, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", F.col("passes").cast("long"),
        (F.col("due") - F.coalesce("before", F.lit(0))).cast("long").alias("due"), F.coalesce("end", F.lit(-1)).alias("end"),
    )
    table = rows.toArrow().sort_by("source")  # a row per source
    table = _stops(table, placed, text)
    passes, ends = (np.array(table[c].to_pylist(), np.int64) for c in ("passes", "end"))
    quotas = passes * BLOCKS + ends + 1
    if shards is None:
        shards = int(np.ceil(sum(float(t) for t in table["target"].to_pylist()) / SHARD_WORDS))
    parts = max(1, -(-shards // BLOCKS))
    cuts = np.cumsum(split_quotas(quotas, max(1, -(-shards // parts)), seed), axis=0)[:-1].T
    pick = np.random.default_rng(seed + 1)
    # In each pass a source's blocks are drawn in an order of their own; a shard draws its stretch of them.
    drawn = [
        [np.searchsorted(c, t * BLOCKS + pick.permutation(BLOCKS if t < p else int(e) + 1), "right").tolist() for t in range(int(p) + 1)]
        for p, e, c in zip(passes, ends, cuts, strict=True)
    ]
    return table.append_column("shards", pa.array(drawn, pa.list_(pa.list_(pa.int16())))), parts


def _stops(table: pa.Table, placed: DataFrame, text: Column) -> pa.Table:
    """The recipe with the place of the document in which the last pass ends, the words due from there, and its copies.

    Only the end's block is read for it, and only places are sorted, equal ones as one row.
    """
    ends = placed.sparkSession.createDataFrame(
        table.select(["source", "due", "end"]).filter(pa.compute.greater(table["due"], 0)), "source string, due long, end int"
    )
    there = placed.join(ends, F.col("of").eqNullSafe(F.col("source")) & (F.col("block") == F.col("end")))
    places = there.withColumn("size", words(text)).groupBy("source", "due", _place(text).alias("stop")).agg(F.count("*").alias("copies"))
    own = F.col("stop.size") * F.col("copies")
    upto = F.sum(own).over(Window.partitionBy("source").orderBy("stop").rowsBetween(Window.unboundedPreceding, 0))
    found = places.withColumn("left", F.col("due") - (upto - own)).where((F.col("left") > 0) & (F.col("left") <= own))
    by_source = {r["source"]: r for r in found.select("source", "left", "stop", "copies").collect()}  # a row per source
    rows = [by_source.get(s) for s in table["source"].to_pylist()]
    kind = pa.struct([("key", pa.string()), ("size", pa.int64()), ("mark", pa.int64())])
    table = table.set_column(table.schema.get_field_index("due"), "due", pa.array([r["left"] if r else 0 for r in rows], pa.int64()))
    table = table.append_column("stop", pa.array([r["stop"].asDict() if r else None for r in rows], kind))
    return table.append_column("copies", pa.array([r["copies"] if r else 0 for r in rows], pa.int64()))


def shard_rows(mixed: DataFrame, seed: int = 7, prefix: str = "", name: str = "mixed") -> DataFrame:
    """A row per draw (columns of the documents, pass, shard, words), laid out by shard in a random local order.

    ``prefix`` goes before the added names; columns of the documents that have one are replaced.
    """
    added = [f"{prefix}{c}" for c in ("pass", "shard", "words")]
    rest = [c for c in mixed.columns if c not in (name, *added)]
    rows = mixed.select(*[F.col(f"`{c}`") for c in rest], F.inline(F.col(name)["draws"]).alias(*added))
    order = F.xxhash64(F.lit(seed), added[0], *[F.col(f"`{c}`") for c in rest])
    return rows.repartition(added[1]).sortWithinPartitions(added[1], order)


#: Rows of the query: the same order and recipe over whole tables.
ORACLE = r"""
    with sized as (
        select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
               md5(coalesce(doc_id::varchar, text, '')) as k
        from documents
    ), totals as (
        select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as place
        from sized group by source
    ), weighed as (
        select *, [5.0, 2.0, 1.0][((place - 1) % 3 + 1)::int]::double as weight, source_size * 2.0::double as lim from totals
    ), levels as (
        select *, ((sum(source_size) over ())::double * 1.5::double
                   - coalesce(sum(lim) over (order by lim / weight, place rows between unbounded preceding and 1 preceding), 0))
                  / sum(weight) over (order by lim / weight, place rows between current row and unbounded following) as level
        from weighed
    ), targets as (
        select source, source_size,
               coalesce(least(lim, weight * max(case when lim > weight * level then level end) over ()), lim)::double as target
        from levels
    ), due as (
        select *, case when source_size > 0 then floor(target)::bigint // source_size else 0 end as passes from targets
    ), ordered as (
        select s.doc_id, s.size, d.source_size, d.target, d.passes, floor(d.target)::bigint - d.passes * d.source_size as rest,
               coalesce(sum(s.size) over (partition by s.source order by s.k, s.size rows between unbounded preceding and 1 preceding), 0)::bigint as before
        from sized s join due d on s.source is not distinct from d.source
    )
    select doc_id, size, source_size, target, (passes * size + greatest(0, least(size, rest - before)))::bigint as taken
    from ordered
"""
