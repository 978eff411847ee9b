"""Spelling variants: exact neighbours at one edit, through numbered trie nodes.

All words form a trie, and all reversed words another.  A node of the first stands
for a prefix, one of the second for a suffix, and each has a number.  A word of L
code points gives L pairs (prefix node, suffix node) that skip one position and
L + 1 that skip none.  Two words with an equal skipping pair differ in that one
code point; a skipping pair of one word that equals a whole pair of another is one
deletion.  So words meet on two integers, whatever their length, and the work is
linear in the letters.

Numbering.  Sorted words visit the trie in preorder, so a pass that keeps the
numbers of the last word's prefixes numbers the nodes: a prefix shared with the
last word has its number, the others take the next ones.  Tasks hold ranges of the
order between cut strings (from a bounded sample of words, for balance alone).  A
prefix that words on both sides of a cut share is a prefix of the cut itself, so it
is numbered by the first cut that has it and its length; every other prefix
belongs to one range.  No numbers are exchanged between tasks.

A key holds at most one whole pair (it spells its word) and one skipping pair for
each letter of the alphabet, so groups are bounded by the alphabet; they are never
expanded into pairs of words.  In a run of equal letters only the last counts as
deleted, so a pair of words is met once.

Defined results: a null or empty text has no words; a null id reads as empty in
the digest that decides on deletions; ties of n go to the smaller word in
code-point order; repeated rows count again, as further occurrences; other columns
do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, quoted, staged

# The letters of a word, those that are lower-cased, and the shift of a range's numbers.
LETTERS = r"[a-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RANGE_BITS = 40
CUT_CHARS = 64            # longest cut string
CUT_BITS = 7              # holds 0 to CUT_CHARS


@dataclass(frozen=True)
class SpellingParams:
    min_length: int = 7
    min_count: int = 2
    form_ratio: int = 10          # a form is at least this many times as frequent
    slip: int = 31                # a run whose digest it divides loses a code point
    range_words: int = 20_000     # words of a range on average, more beyond max_ranges
    max_ranges: int = 2048        # bounds the cut strings, which every task gets
    sample_per_range: int = 50


# ------------------------------------------------------------------ words

def runs(doc_id: Column, text: Column, p: SpellingParams) -> Column:
    """The words of one text, with the code point taken out where the digest says so."""
    def word(run):
        h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
        cut = (h % F.length(run)).cast("int")
        return F.when(h % p.slip != 0, run).otherwise(F.concat(F.substring(run, F.lit(1), cut), F.substring(run, cut + 2, F.length(run))))

    # a shorter run cannot give a word; the possessive form takes maximal runs
    found = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(f"{LETTERS}{{{p.min_length},}}+"), 0)
    return F.filter(F.transform(found, word), lambda w: F.length(w) >= p.min_length)


def vocabulary(docs: DataFrame, p: SpellingParams, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of the words found often enough."""
    words = docs.select(F.explode(runs(F.col(quoted(doc_id)), F.col(quoted(text)), p)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= p.min_count)


# ------------------------------------------------------------------ numbering

def cuts(words: DataFrame, column: str, p: SpellingParams) -> list[str]:
    """At most ``max_ranges`` - 1 strings of bounded length that part the words into ranges of like size."""
    n = words.count()
    ranges = min(-(-n // p.range_words), p.max_ranges)
    if ranges < 2:
        return []
    share = F.shiftrightunsigned(F.xxhash64(F.lit(12), column), 11) / F.lit(float(1 << 53))
    wanted = ranges * p.sample_per_range
    sample = words.where(share < wanted / n).select(F.substring(column, 1, CUT_CHARS).alias("head")).limit(2 * wanted)
    heads = sorted(r["head"] for r in sample.collect())
    return sorted({heads[k * len(heads) // ranges] for k in range(1, ranges)} if heads else [])


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _cut_numbers(chosen: list[str]) -> list[list[int]]:
    """For each cut the number of each of its prefixes: that of the first cut which has it."""
    out: list[list[int]] = []
    for k, cut in enumerate(chosen):
        same = shared(chosen[k - 1], cut) + 1 if k else 0
        before = out[k - 1][:same] if k else []
        out.append(before + [-1 - (k << CUT_BITS | depth) for depth in range(len(before), len(cut) + 1)])
    return out


def _numberer(chosen: list[str], column: str, others: list[tuple[str, pa.DataType]]):
    """For each word of sorted ranges the numbers of its prefixes, the empty one first, and its own place in the order."""
    schema = pa.schema([("rank", pa.int64()), (column, pa.string()), *others, ("nodes", pa.list_(pa.int64()))])

    def run(batches):
        named = _cut_numbers(chosen)
        part, last, nodes, free, place = None, "", [], 0, 0
        for batch in batches:
            ranks, lists = [], []
            for word, k in zip(batch.column(column).to_pylist(), batch.column("part").to_pylist(), strict=True):
                if k != part:
                    part, last, nodes, free, place = k, "", [], k << RANGE_BITS, k << RANGE_BITS
                near = [(shared(word, chosen[j]), j) for j in (k - 1, k) if 0 <= j < len(chosen)]
                fixed, j = max(near, default=(-1, -1))
                kept = min(shared(word, last) + 1, len(nodes))
                nodes = nodes[:kept]
                if fixed >= kept:
                    nodes += named[j][kept:fixed + 1]
                fresh = len(word) + 1 - len(nodes)
                nodes += range(free, free + fresh)
                free += fresh
                last = word
                ranks.append(place)
                place += 1
                lists.append(nodes)
                if len(lists) >= 2000 or len(nodes) > 100_000:
                    yield from emit(batch, ranks, lists)
                    batch, ranks, lists = batch.slice(len(lists)), [], []
            yield from emit(batch, ranks, lists)

    def emit(batch, ranks, lists):
        if lists:
            kept = batch.slice(0, len(lists))
            yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), kept.column(column), *[kept.column(c) for c, _ in others],
                                              pa.array(lists, pa.list_(pa.int64()))], schema=schema)

    return run


def numbered(words: DataFrame, column: str, p: SpellingParams, carried: dict[str, str]) -> DataFrame:
    """``rank, <column>, <carried>, nodes``: the trie numbers of each word's prefixes; ``rank`` follows the word order.

    ``words`` must be distinct in ``column`` and stored, as it is read several times.
    """
    types = {"long": pa.int64(), "string": pa.string()}
    chosen = cuts(words, column, p)
    held = words.sparkSession.sparkContext.broadcast(chosen)

    def part_of(batches):
        for batch in batches:
            yield batch.append_column("part", pa.array([bisect_right(held.value, w) for w in batch.column(column).to_pylist()], pa.int64()))

    def run(batches):
        yield from _numberer(held.value, column, [(c, types[t]) for c, t in carried.items()])(batches)

    kept = "".join(f", {quoted(c)} {t}" for c, t in carried.items())
    placed = words.select(column, *carried).mapInArrow(part_of, f"{column} string{kept}, part long")
    dealt = placed.repartition(len(chosen) + 1, "part").sortWithinPartitions("part", column)
    return dealt.mapInArrow(run, f"rank long, {column} string{kept}, nodes array<long>")


# ------------------------------------------------------------------ neighbours

WHOLE, SKIP, SKIP_LAST = 0, 1, 2


def node_pairs(words: DataFrame) -> DataFrame:
    """``p, s, kind, rank, n`` from ``word, rank, n, ahead, back``: the pairs of each word."""
    size = F.size("ahead") - 1

    def skipped(letters):
        return F.transform(letters, lambda c, i: F.struct(
            F.get(F.col("ahead"), i).alias("p"), F.get(F.col("back"), size - 1 - i).alias("s"),
            F.when(c.eqNullSafe(F.get(letters, i + 1)), SKIP).otherwise(SKIP_LAST).alias("kind")))

    whole = F.transform("ahead", lambda node, i: F.struct(node.alias("p"), F.get(F.col("back"), size - i).alias("s"), F.lit(WHOLE).alias("kind")))
    letters = F.filter(F.split("word", ""), lambda c: c != "")
    return words.select("rank", "n", F.explode(F.concat(whole, let(letters, skipped))).alias("k")).select("k.p", "k.s", "k.kind", "rank", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """``rank, n_near, best`` of each word with a neighbour; best is ``struct<n, order, rank>`` of the near word of largest n."""
    # the order of words falls where best is the greatest struct
    member = F.struct("n", (-F.col("rank")).alias("order"), "rank", "kind")
    # dealt first: collecting before the shuffle would sort every row twice
    groups = node_pairs(words).repartition("p", "s").groupBy("p", "s").agg(F.sort_array(F.collect_list(member), asc=False).alias("all")).where(F.size("all") > 1)

    def of(members):
        skips = F.filter(members, lambda m: m["kind"] != WHOLE)

        def with_skips(s):
            ends = F.filter(s, lambda m: m["kind"] == SKIP_LAST)
            whole = F.get(F.filter(members, lambda m: m["kind"] == WHOLE), 0)

            def each(m):
                # members are sorted, so the best other one is the first or the second
                other = F.when(F.get(s, 0)["rank"] == m["rank"], F.get(s, 1)).otherwise(F.get(s, 0))
                met = F.when(m["kind"] == SKIP_LAST, whole)
                return F.when(m["kind"] == WHOLE, F.struct(m["rank"].alias("rank"), F.size(ends).alias("near"), F.get(ends, 0).alias("best"))) \
                    .otherwise(F.struct(m["rank"].alias("rank"), (F.size(s) - 1 + met.isNotNull().cast("int")).alias("near"),
                                        F.greatest(other, met).alias("best")))
            return F.transform(members, each)

        return let(skips, with_skips)

    links = groups.select(F.explode(of(F.col("all"))).alias("l")).select("l.*").where("near > 0")
    return links.groupBy("rank").agg(F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``rank, root`` from ``rank, form``: forms followed to the last, by doubling; each round is written out."""
    now = staged(forms.select("rank", F.col("form").alias("root")), "forms")
    while True:
        step = now.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        more = staged(now.join(step, "root", "left").select("rank", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = more.select("rank", "root")
        if more.where("moved").isEmpty():
            return now


def spelling_groups(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` from a table of distinct ``word, n``."""
    words = staged(words.select("word", F.col("n").cast("long").alias("n")), "words")
    ahead = numbered(words, "word", params, {"n": "long"}).withColumnRenamed("nodes", "ahead")
    turned = words.select(F.reverse("word").alias("turned"), "word")
    back = numbered(turned, "turned", params, {"word": "string"}).select("word", F.col("nodes").alias("back"))
    both = staged(ahead.join(back, "word"), "tries")
    near = staged(neighbours(both).withColumns({"form_n": F.col("best.n"), "form": F.col("best.rank")})
                  .select("rank", "n_near", "form", "form_n"), "near")
    rated = both.select("rank", "word", "n").join(near, "rank", "left")
    known = F.col("form_n") >= params.form_ratio * F.col("n")
    rated = staged(rated.withColumns({"form": F.when(known, F.col("form")), "form_n": F.when(known, F.col("form_n"))}), "rated")
    ends = roots(rated.where("form IS NOT NULL").select("rank", "form"))
    # names of the few forms and roots; staged, so that the joins read plain exchanges
    targets = staged(rated.join(ends, "rank").select(F.col("rank").alias("of"), F.explode(F.array(
        F.struct(F.lit("form").alias("role"), F.col("form").alias("rank")), F.struct(F.lit("root").alias("role"), F.col("root").alias("rank")))).alias("t"))
        .select("of", "t.role", "t.rank").join(both.select("rank", "word"), "rank")
        .groupBy("of").agg(*[F.max(F.when(F.col("role") == r, F.col("word"))).alias(r) for r in ("form", "root")]), "names")
    out = rated.select("rank", "word", "n", "n_near", "form_n").join(targets, F.col("rank") == F.col("of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, params: SpellingParams = SpellingParams(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of the texts: ``word, form, root, n, n_near, form_n``."""
    return spelling_groups(vocabulary(docs, params, doc_id, text), params)
