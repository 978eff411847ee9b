"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are words.  Each source gets a target: its weight's share of
``total_share`` times all words, at most ``max_repeat`` times its own size, with
the excess reshared by weight.  A source's documents are dealt by hash into
blocks; whole passes take every block, and one further pass takes blocks in
permuted order as long as they fit into the rest, and the one that then comes
nearest.  A second hash deals blocks
into parts, so many that a part of the largest source has about ``unit_words``;
every (pass, block, part) is a unit, so a source's quota of units is exact.

The quotas are split among output shards by a binary tree: each node holds the
units of every source that its shards will get and draws, without replacement,
those of its left half (a multivariate hypergeometric draw by selection
sampling).  A shard then takes the next units of each source's permutation, so
shards are disjoint, and orders its rows by hash.

All randomness is a hash of ids, so reruns agree.  The tree sees counts of
sources only.  Documents are joined once, on (source, block, part), so a source
of any size is spread.

Defined results: a null text has size 0; the null source is a source, ordered
last; sources of size 0 have target 0; repeated rows lie in one block and are
taken alike; null ids are hashed with the text; an empty table gives an empty
result; extra columns are carried by :func:`mix`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, quoted, staged, word_array


@dataclass(frozen=True)
class MixingParams:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)   # repeating over the sources in code point order
    total_share: float = 1.5
    max_repeat: int = 2
    blocks: int = 1024             # of a source; bounds each source's arrays
    unit_words: int = 1 << 20      # of a part of a block
    shard_words: int = 1 << 23     # of an output shard; their number is the next power of two
    seed: int = 42


def _uniform(*parts: Column | int | str) -> Column:
    """A uniform double in [0, 1) from a hash."""
    h = F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def targets(sizes: DataFrame, p: MixingParams) -> DataFrame:
    """``source, source_size, target`` for ``source, source_size``; a table of sources only."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weights = F.array(*[F.lit(float(w)) for w in p.weights])
    weighted = (sizes.withColumn("rank", F.row_number().over(by_name) - 1)
                .withColumn("w", F.get(weights, F.col("rank") % len(p.weights)))
                .withColumn("top", p.max_repeat * F.col("source_size").cast("double"))
                .withColumn("ratio", F.col("top") / F.col("w")))
    # level = the share for each unit of weight at which all targets add up: sources
    # are full in the order of size for each weight, the rest share what is left
    order = Window.orderBy("ratio", "rank")
    total = F.sum("source_size").over(Window.partitionBy()) * p.total_share
    full = F.coalesce(F.sum("top").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levelled = weighted.withColumn("level", (total - full) / open_weight)
    level = F.coalesce(
        F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank"))).over(Window.partitionBy()),
        F.max("ratio").over(Window.partitionBy()))
    return levelled.select("source", "source_size", "rank", F.least("top", level * F.col("w")).alias("target"))


def _block_of(id_: Column, text: Column, p: MixingParams) -> Column:
    return F.pmod(F.xxhash64(F.lit(p.seed), id_, text), F.lit(p.blocks)).cast("int")


def _planned_blocks(blocks: DataFrame, p: MixingParams) -> DataFrame:
    """``source, source_size, target, rank, block, copies`` of every ``source, block, size``."""
    goals = targets(blocks.groupBy("source").agg(F.sum("size").alias("source_size")), p)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.col("target") - passes * F.col("source_size")
    # at most ``blocks`` entries: first fit in permuted order
    listed = blocks.groupBy("source").agg(F.sort_array(F.collect_list(F.struct(
        F.xxhash64(F.lit(p.seed + 1), F.col("source"), F.col("block")).alias("order"), "block", "size"))).alias("list"))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<int>").alias("extra"))

    def first_fit(rest):
        return F.aggregate(F.col("list"), zero, lambda a, b: F.when(
            a["sum"] + b["size"] <= rest,
            F.struct((a["sum"] + b["size"]).alias("sum"), F.concat(a["extra"], F.array(b["block"])).alias("extra")))
            .otherwise(a), lambda a: F.struct((rest - a["sum"]).alias("left"), a["extra"].alias("extra")))

    def nearest(a):
        # one more block, where that comes closer to the target than stopping short of it
        unused = F.filter("list", lambda b: ~F.array_contains(a["extra"], b["block"]))
        best = F.array_min(F.transform(unused, lambda b: F.struct(F.abs(a["left"] - b["size"]).alias("off"), b["block"].alias("block"))))
        return let(best, lambda b: F.when(b["off"] < a["left"], F.concat(a["extra"], F.array(b["block"]))).otherwise(a["extra"]))

    same = listed["source"].eqNullSafe(goals["source"])
    joined = goals.join(listed, same).select(goals["source"], "source_size", "target", "rank", "list",
                                             passes.alias("passes"), let(let(rest, first_fit), nearest).alias("extra"))
    taken = joined.withColumn("extra", F.sort_array("extra"))
    return taken.select("source", "source_size", "target", "rank", F.explode("list").alias("b"), "passes", "extra").select(
        "source", "source_size", "target", "rank", F.col("b.block").alias("block"),
        (F.col("passes") + F.array_contains("extra", F.col("b.block")).cast("int")).alias("copies"))


def split_tree(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """``shard, rank, n``: units of each source for each of ``n_shards`` (a power of two), from ``rank, n``."""
    root = quotas.agg(F.sort_array(F.collect_list(F.struct("rank", F.col("n").cast("int").alias("n")))).alias("q"))
    nodes = root.select(F.lit(0).alias("node"), "q")
    shards, level = 1, 0
    while shards < n_shards:
        total = F.aggregate("q", F.lit(0), lambda a, s: a + s["n"])
        salt, node = seed + 7 * (level + 1), F.col("node")

        def draw(state, s):
            # unit by unit: it goes left with the chance (still wanted) / (still left)
            def unit(a, j):
                left = _uniform(salt, node, s["rank"], j) * a["left"] < a["want"]
                return F.struct((a["left"] - 1).alias("left"), (a["want"] - left.cast("int")).alias("want"))
            start = F.struct(state["left"].alias("left"), state["want"].alias("want"))
            after = F.aggregate(F.when(s["n"] > 0, F.sequence(F.lit(1), s["n"])).otherwise(
                F.array().cast("array<int>")), start, unit)
            return let(after, lambda a: F.struct(
                a["left"].alias("left"), a["want"].alias("want"),
                F.concat(state["out"], F.array(F.struct(s["rank"].alias("rank"), (state["want"] - a["want"]).alias("n"))))
                .alias("out")))

        zero = F.struct(total.alias("left"), F.floor(total / 2).cast("int").alias("want"),
                        F.array().cast("array<struct<rank:int,n:int>>").alias("out"))
        halved = nodes.withColumn("l", F.aggregate("q", zero, draw, lambda a: a["out"]))
        right = F.zip_with("q", "l", lambda a, b: F.struct(a["rank"].alias("rank"), (a["n"] - b["n"]).alias("n")))
        nodes = halved.select(F.explode(F.array(
            F.struct((2 * node).alias("node"), F.col("l").alias("q")),
            F.struct((2 * node + 1).alias("node"), right.alias("q")))).alias("c")).select("c.node", "c.q")
        shards, level = 2 * shards, level + 1
    return nodes.select(F.col("node").alias("shard"), F.explode("q").alias("s")).select("shard", "s.rank", "s.n")


def shard_count(total: int, p: MixingParams) -> int:
    """The power of two that gives shards of at most ``shard_words``."""
    return 1 << max(0, math.ceil(math.log2(max(1.0, total * p.total_share / p.shard_words))))


def _scale(base: DataFrame, p: MixingParams) -> tuple[int, int]:
    """(parts of a block, output shards) for the table's sizes."""
    sizes = base.groupBy("source").agg(F.sum("size").alias("n"))
    total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return max(1, math.ceil(largest / p.blocks / p.unit_words)), shard_count(total, p)


def _plan(base: DataFrame, n_shards: int, p: MixingParams) -> DataFrame:
    """``__source, __block, __part, source_size, target, __shards``: one row for each part that has documents.

    ``__shards`` has one entry for each copy.
    """
    parts = staged(base.groupBy("source", "block", "part").agg(F.sum("size").alias("size")), "mix-parts")
    blocks = _planned_blocks(parts.groupBy("source", "block").agg(F.sum("size").alias("size")), p)
    here = parts.select(F.col("source").alias("s"), F.col("block").alias("b"), "part")
    every = staged(here.join(blocks, F.col("s").eqNullSafe(F.col("source")) & (F.col("b") == F.col("block"))).drop("s", "b"),
                   "mix-plan")
    quotas = every.groupBy("rank").agg(F.sum("copies").alias("n"))
    # the shards of a source are intervals of its permutation
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (split_tree(quotas, n_shards, p.seed).where("n > 0")
              .select("rank", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int").alias("at"), "shard"))
    units = every.where("copies > 0").select("rank", "block", "part", F.explode(
        F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    place = Window.partitionBy("rank").orderBy(F.xxhash64(
        F.lit(p.seed + 2), F.col("rank"), F.col("copy"), F.col("block"), F.col("part")), "copy", "block", "part")
    numbered = units.withColumn("at", F.row_number().over(place) - 1)
    # a unit lies in the shard whose interval started last
    latest = Window.partitionBy("rank").orderBy("at", F.col("block").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = numbered.withColumn("shard", F.lit(None).cast("int")).unionByName(starts, allowMissingColumns=True)
    of_unit = (both.withColumn("shard", F.last("shard", ignorenulls=True).over(latest)).where("block IS NOT NULL")
               .groupBy("rank", "block", "part").agg(F.sort_array(F.collect_list("shard")).alias("shards")))
    return every.join(of_unit, ["rank", "block", "part"], "left").select(
        F.col("source").alias("__source"), F.col("block").alias("__block"), F.col("part").alias("__part"),
        "source_size", "target", F.coalesce("shards", F.array().cast("array<int>")).alias("__shards"))


def _spot(id_: Column, text: Column, p: MixingParams) -> Column:
    """A hash of the document; modulo the number of parts it is the part of its block."""
    return F.xxhash64(F.lit(p.seed + 4), id_, text)


def _base(docs: DataFrame, p: MixingParams, doc_id: str, text: str, source: str) -> DataFrame:
    body = F.col(quoted(text))
    return docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(source)).alias("source"),
                       F.size(word_array(body)).cast("long").alias("size"),
                       _block_of(F.col(quoted(doc_id)), body, p).alias("block"),
                       _spot(F.col(quoted(doc_id)), body, p).alias("spot"))


def mixture(docs: DataFrame, params: MixingParams = MixingParams(), doc_id: str = "doc_id",
            text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, shards``."""
    base = staged(_base(docs, params, doc_id, text, source), "mix-base")
    n_parts, n_shards = _scale(base, params)
    base = base.withColumn("part", F.pmod("spot", F.lit(n_parts)))
    plan = _plan(base, n_shards, params)
    same = (base["source"].eqNullSafe(plan["__source"]) & (base["block"] == plan["__block"])
            & (base["part"] == plan["__part"]))
    return base.join(plan, same).select("doc_id", "size", "source_size", "target",
                                        (F.col("size") * F.size("__shards")).alias("taken"),
                                        F.array_join("__shards", ",").alias("shards"))


def mix(docs: DataFrame, params: MixingParams = MixingParams(), doc_id: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """The mixed rows: each document once for each copy, with its ``shard``, shuffled within shards."""
    base = staged(_base(docs, params, doc_id, text, source), "mix-base")
    n_parts, n_shards = _scale(base, params)
    wanted = _plan(base.withColumn("part", F.pmod("spot", F.lit(n_parts))), n_shards, params).drop("source_size", "target")
    body, id_ = F.col(quoted(text)), F.col(quoted(doc_id))
    same = (F.col(quoted(source)).eqNullSafe(F.col("__source")) & (_block_of(id_, body, params) == F.col("__block"))
            & (F.pmod(_spot(id_, body, params), F.lit(n_parts)) == F.col("__part")))
    rows = docs.join(wanted, same).select(*[F.col(quoted(c)) for c in docs.columns],
                                          F.posexplode("__shards").alias("__copy", "__shard"))
    order = F.xxhash64(F.lit(params.seed + 3), F.col("__shard"), F.col("__copy"), id_, body)
    dealt = rows.withColumn("__order", order).repartitionById(n_shards, F.col("__shard")).sortWithinPartitions("__shard", "__order")
    shard = "shard" if "shard" not in docs.columns else "mix_shard"
    return dealt.select(*[quoted(c) for c in docs.columns], F.col("__shard").alias(shard))
