"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are 64-bit majority votes over word-shingle hashes.  Two link when
at most ``max_bits`` bits differ; linked documents form a group.

1. Distinct fingerprints are dealt into buckets.  The bits are cut into
   ``max_bits + exact_blocks`` blocks; two linked fingerprints agree on at least
   ``exact_blocks`` of them, so each choice of that many blocks is a bucket key
   and no link is lost.
2. Within a bucket fingerprints are in Gray rank order, where neighbours share
   long bit patterns.  Runs of neighbours become nodes that hold the bits all
   members share; upper nodes factor the patterns of their children.  The
   self-join walks pairs of nodes downwards, adds the differences that each
   level's newly shared bits show, and drops the whole pair of groups when the
   sum passes ``max_bits``.
3. A bucket emits a star for each local group (at most one edge for each
   member), never its pairs.  Alternating large-star and small-star rounds over
   the edges give the groups.

A bucket of more than ``tile`` fingerprints is cut into tiles, and every pair
of tiles is its own group, so no task holds more than two tiles.

Defined results: a null or wordless text has fingerprint zero and links like
any other; a text shorter than the shingle is one shingle; repeated rows share
a fingerprint; null ids are never a group's smallest id unless all are null; an
empty table gives an empty result.
"""

from __future__ import annotations


from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged

LEAF = 16          # members of a leaf, children of an upper node
SMALL = 48         # buckets up to this size are one leaf and compared directly
VOTE_CHUNK = 1 << 15
PAIR_CHUNK = 1 << 13


def fingerprint_of(data: bytes | None, width: int, seed: int) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    words = data.lower().split() if data else []
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        begin, end = starts[:len(words) - width + 1].tolist(), (starts + sizes)[width - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begin, end, strict=True)), np.uint64, len(begin))
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), VOTE_CHUNK):
        part = hashes[i:i + VOTE_CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, width: int, seed: int = 42) -> Column:
    @F.arrow_udf("long")
    def run(data: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(x.as_py(), width, seed) for x in data], pa.int64())

    return run(text.cast("binary"))


# ------------------------------------------------------------------ one bucket

def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member index of each local group after adding the links (i, j)."""
    while True:
        roots_i, roots_j = label[i], label[j]
        if np.array_equal(roots_i, roots_j):
            return label
        low = np.minimum(roots_i, roots_j)
        label = label.copy()
        # only roots are hooked, so members keep pointing into their old group
        np.minimum.at(label, roots_i, low)
        np.minimum.at(label, roots_j, low)
        while not np.array_equal(label, label[label]):
            label = label[label]


def _levels(f: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(shared bits, their values) of the nodes, members first, root level last."""
    levels = [(np.full(len(f), ~np.uint64(0)), f)]
    ones, anys = f, f
    while len(ones) > LEAF:
        cuts = np.arange(0, len(ones), LEAF)
        ones, anys = np.bitwise_and.reduceat(ones, cuts), np.bitwise_or.reduceat(anys, cuts)
        levels.append((~(ones ^ anys), ones))
    return levels


def index_labels(f: np.ndarray, max_bits: int) -> np.ndarray:
    """Group labels of fingerprints in Gray order, by the node-pair walk."""
    levels = _levels(f)
    label = np.arange(len(f))
    top = len(levels) - 1
    n = len(levels[top][0])
    a, b = np.triu_indices(n)
    zeros = np.zeros(len(a), np.uint64)
    todo = [(top, a, b, zeros, np.zeros(len(a), np.int64))]
    while todo:
        level, a, b, seen, diff = todo.pop()
        if len(a) > PAIR_CHUNK:
            for k in range(0, len(a), PAIR_CHUNK):
                todo.append((level, *(x[k:k + PAIR_CHUNK] for x in (a, b, seen, diff))))
            continue
        mask, value = levels[level]
        shared = mask[a] & mask[b]
        diff = diff + np.bitwise_count((value[a] ^ value[b]) & shared & ~seen)
        near = diff <= max_bits
        if level == 0:
            near &= a != b
            if near.any():
                label = merge_labels(label, a[near], b[near])
            continue
        a, b, shared, diff = a[near], b[near], shared[near], diff[near]
        if not len(a):
            continue
        k = np.arange(LEAF)
        ca = (a[:, None, None] * LEAF + k[None, :, None]) + 0 * k[None, None, :]
        cb = (b[:, None, None] * LEAF + k[None, None, :]) + 0 * k[None, :, None]
        size = len(levels[level - 1][0])
        ok = (ca < size) & (cb < size) & (ca <= cb)
        many = np.broadcast_to(shared[:, None, None], ca.shape)[ok]
        sums = np.broadcast_to(diff[:, None, None], ca.shape)[ok]
        todo.append((level - 1, ca[ok], cb[ok], many, sums))
    return label


def bucket_edges(group: np.ndarray, f: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, root) over rows sorted by bucket number and Gray rank."""
    n = len(f)
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    sizes = np.diff(cuts)
    label = np.arange(n)
    small = np.repeat(sizes <= SMALL, sizes)
    left, right = [], []
    for step in range(1, min(SMALL, int(sizes.max(initial=1)))):
        i = np.flatnonzero(small[:-step] & (group[:-step] == group[step:]))
        if not len(i):
            break
        i = i[np.bitwise_count(f[i] ^ f[i + step]) <= max_bits]
        left.append(i)
        right.append(i + step)
    if left:
        label = merge_labels(label, np.concatenate(left), np.concatenate(right))
    for c, size in zip(cuts[:-1][sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        label[c:c + size] = c + index_labels(f[c:c + size], max_bits)
    at = np.flatnonzero(label != np.arange(n))
    return f[at], f[label[at]]


def _edges_of_partition(max_bits: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("combo", "key", "a", "b", "fp")]
            if held is not None:
                cols = [np.concatenate((h, c)) for h, c in zip(held, cols, strict=True)]
            change = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0) if len(cols[0]) > 1 else np.zeros(0, bool)
            ends = np.flatnonzero(change)
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield from emit(cols, change, cut)
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]):
            yield from emit(held, np.any([c[1:] != c[:-1] for c in held[:4]], axis=0), len(held[0]))

    def emit(cols, change, cut):
        group = np.concatenate(([0], np.cumsum(change[:cut - 1])))
        u, v = bucket_edges(group, cols[4][:cut].astype(np.int64).view(np.uint64), max_bits)
        if len(u):
            u, v = u.view(np.int64), v.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], schema=schema)

    return run


# ------------------------------------------------------------------ Spark side

def _masks(max_bits: int, exact_blocks: int) -> list[int]:
    blocks = max_bits + exact_blocks
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    one = [((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in range(blocks)]
    out = []
    for chosen in combinations(range(blocks), exact_blocks):
        mask = sum(one[k] for k in chosen)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _gray_rank(fp: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def links(fingerprints: DataFrame, max_bits: int, exact_blocks: int = 2, tile: int = 1 << 14) -> DataFrame:
    """Edges (u, v), u > v, that connect every group of distinct ``fp`` values."""
    keys = F.array(*[F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(_masks(max_bits, exact_blocks))])
    rows = fingerprints.select("fp", F.explode(keys).alias("k")).select("fp", "k.combo", "k.key")
    # a bucket of one has no links; the others learn how many tiles they need.  Staged, so
    # that the join reads two plain exchanges and a hot bucket's rows can be split
    sizes = staged(rows.groupBy("combo", "key").count().where("count > 1"), "buckets")
    sized = rows.join(sizes, ["combo", "key"])
    tiles = F.ceil(F.col("count") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(
        F.least(F.col("mine"), t).alias("a"), F.greatest(F.col("mine"), t).alias("b")))
    dealt = (sized.withColumn("tiles", tiles).withColumn("mine", mine)
             .select("combo", "key", "fp", F.explode(pairs).alias("p"))
             .select("combo", "key", "p.a", "p.b", "fp", _gray_rank(F.col("fp")).alias("gray")))
    n = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (dealt.repartition(n, "combo", "key", "a", "b")
                   .sortWithinPartitions("combo", "key", "a", "b", "gray").drop("gray"))
    return sorted_rows.mapInArrow(_edges_of_partition(max_bits), "u long, v long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(u, v): each node of ``edges`` but the smallest of its group, with that smallest.

    Alternating large-star and small-star; every round is written to the shared
    folder, so a lost executor costs one round.
    """
    now = staged(edges.where("u > v"), name)
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u > v").distinct())
        now = staged(small, name)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return now
        before = state


def _grouped(prints: DataFrame, max_bits: int, exact_blocks: int) -> DataFrame:
    """``fp, root`` of each distinct fingerprint."""
    distinct = prints.select("fp").distinct()
    found = components(links(distinct, max_bits, exact_blocks), "simhash")
    return (distinct.join(found.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, max_bits: int = 4, width: int = 4, exact_blocks: int = 2,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (hex), ``component_id`` (smallest id)."""
    prints = staged(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), width).alias("fp")), "prints")
    roots = _grouped(prints, max_bits, exact_blocks)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    by_fp = roots.join(first, "fp")
    ids = by_fp.groupBy("root").agg(F.min("first").alias("component_id"))
    named = by_fp.join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = 4, width: int = 4, exact_blocks: int = 2,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each group: that of the smallest id (nulls last)."""
    row, fp = "__row", "__fp"
    held = staged(docs.withColumns({row: F.monotonically_increasing_id(), fp: fingerprint(F.col(text), width)}), "kept")
    prints = held.select(F.col(quoted(doc_id)).alias("id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    roots = _grouped(prints, max_bits, exact_blocks)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    keep = roots.join(first, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return held.join(keep, row, "left_semi").select(*[quoted(c) for c in docs.columns])
