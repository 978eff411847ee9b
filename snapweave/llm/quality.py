"""Quality rules: distribution divergence from language references.

Every document gets two histograms: character classes and common words.  Both
are compared with references of each language by Jensen-Shannon distance; the
language whose two distances have the smallest sum counts.  References are
sums over all documents that carry a language and pass the base rules.  Texts
below the length guards keep the base verdict, since short histograms are
noise.  All words that are not common share one bin, so a text of rare words is far
from every language.  The limit of the word distance comes from its spread over all
documents above the guard whose number of words has the same binary length: the upper
quartile plus ``fence`` times the distance of the quartiles, counted in bins of a
thousandth.  A short histogram scatters more, so a longer text never gets a wider
limit than a shorter one.  Everything is built-in functions
inside one row, so no document is shuffled.

Defined results: a null or empty text has no words and fails the base rules;
a null language takes no part in the references but is judged like any other;
without references (empty table, no language) only the base rules decide;
repeated rows are judged alike; extra columns are carried by
:func:`filter_quality` and ignored by :func:`judge`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAP, count_chars, let, quoted, staged, word_array

# Each class as the pattern of everything outside it.
CLASSES = (("vowels", "[^aeiou]+"), ("upper", r"[^\p{Lu}]+"), ("digits", "[^0-9]+"),
           ("symbols", "[^#*$%&|<>]+"), ("points", r"[^.,;:!?'\"()-]+"), ("accented", r"[\x00-\x7F]+"))
FEATURES = "__features"


@dataclass(frozen=True)
class QualityParams:
    """Limits of the base rules, of the guards and of the verdict."""

    min_words: int = 20
    repeat_window: int = 8
    max_repeat_pct: int = 30
    common_words: int = 32          # per language
    common_word_chars: int = 5      # function words are short
    guard_words: int = 50           # below: no divergence verdict
    max_char_distance: float = 0.32
    fence: float = 3.0              # quartile distances above the upper quartile
    min_word_limit: float = 0.3     # documents of one kind have no spread; closer than this is no divergence


@dataclass
class References:
    """Common words, and per language the share of each class, and of each common word and all others."""

    words: list[str] = field(default_factory=list)
    chars: dict[str, list[float]] = field(default_factory=dict)
    common: dict[str, list[float]] = field(default_factory=dict)
    word_limits: list[float] = field(default_factory=list)     # of the word distance, by binary length of the number of words


def repeated_words(words: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that occur at least twice."""
    starts = F.size(words) - window + 1

    def doubled(size):
        # a window of ``2 * size`` words is the pair of the windows of ``size`` at its two ends
        return lambda h: F.zip_with(h, F.slice(h, size + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    size = 1
    while size < window:
        step = min(size, window - size)
        hashes, size = let(hashes, doubled(step)), size + step
    hashes = F.when(starts >= 2, F.slice(hashes, F.lit(1), starts))

    def covered(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twins(s):
            return F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))

        at = F.sort_array(F.transform(let(ordered, twins), lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(at, zero, lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(window), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    count = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.coalesce(F.when(starts >= 2, count), F.lit(0)).cast("long")


def _runs(ids: Column) -> Column:
    """Sorted small ints as ``array<struct<k, n>>``."""
    def count(s):
        distinct = F.array_distinct(s)
        return let(distinct, lambda d: F.transform(d, lambda k, i: F.struct(
            k.alias("k"), (F.coalesce(F.array_position(s, F.get(d, i + 1)), F.size(s) + F.lit(1))
                           - F.array_position(s, k)).cast("int").alias("n"))))
    return let(F.sort_array(ids), count)


def _others(runs: Column, n_words: Column, k: int) -> Column:
    """The bin of all other words, if there are any, as a run of its own."""
    bin_of = lambda n: F.filter(F.array(F.struct(F.lit(k).alias("k"), n.cast("int").alias("n"))), lambda x: x["n"] > 0)
    return bin_of(n_words - F.aggregate(runs, F.lit(0), lambda a, r: a + r["n"]))


def _short_words(words: Column, p: QualityParams) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) <= p.common_word_chars), lambda w: F.lower(w))


def common_words(docs: DataFrame, p: QualityParams, text: str = "text", lang: str = "lang") -> list[str]:
    """The most frequent short words of each language, counted over all documents."""
    short = _short_words(word_array(F.col(quoted(text))), p)
    counts = (docs.where(F.col(quoted(lang)).isNotNull())
              .select(F.col(quoted(lang)).alias("lang"), F.explode(short).alias("word"))
              .groupBy("lang", "word").count())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("count").desc(), "word"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= p.common_words)
    return sorted({r["word"] for r in top.collect()})


def with_features(docs: DataFrame, words: list[str], p: QualityParams, text: str = "text") -> DataFrame:
    """``docs`` plus one struct column of counts; the text is read in the same row."""
    t = F.coalesce(F.col(quoted(text)), F.lit(""))
    listed = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    ids = F.array().cast("array<int>") if not words else F.transform(
        F.filter(_short_words(F.col("__words"), p), lambda w: w.isin(words)),
        lambda w: F.array_position(listed, w).cast("int") - 1)
    counted = docs.withColumn("__words", word_array(F.col(quoted(text)))).withColumn("__base", F.struct(
        F.size("__words").cast("long").alias("n_words"),
        count_chars(t, WORD_GAP).cast("long").alias("word_chars"),
        F.length(t).alias("n_chars"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words"), p.repeat_window).alias("n_repeat_words"),
        F.array(*[count_chars(t, outside) for _, outside in CLASSES]).alias("classes"),
        let(_runs(ids), lambda r: F.concat(r, _others(r, F.size("__words"), len(words)))).alias("common")))
    b = F.col("__base")
    known = F.aggregate(b["classes"], F.lit(0), lambda a, x: a + x)
    spaces = b["n_chars"] - b["word_chars"]
    failed = (b["n_words"] < p.min_words) | (100 * b["n_repeat_words"] > p.max_repeat_pct * b["n_words"])
    return counted.withColumn(FEATURES, F.struct(
        b["n_words"].alias("n_words"), b["word_chars"].alias("word_chars"),
        b["classes"][3].cast("long").alias("n_symbols"), b["n_dup_lines"].alias("n_dup_lines"),
        b["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"),
        F.concat(b["classes"], F.array(spaces.cast("int"), F.greatest(b["n_chars"] - known - spaces, F.lit(0)).cast("int")))
        .alias("classes"), b["common"].alias("common"))).drop("__words", "__base")


def references(features: DataFrame, words: list[str], lang: str = "lang") -> References:
    """Class and common-word shares of each language, summed over all sound documents."""
    sound = features.where(F.col(quoted(lang)).isNotNull() & ~F.col(f"{FEATURES}.base_failed"))
    flat = F.concat(
        F.transform(F.col(f"{FEATURES}.classes"), lambda n, i: F.struct((-i - 1).alias("k"), n.alias("n"))),
        F.col(f"{FEATURES}.common"))
    rows = (sound.select(F.col(quoted(lang)).alias("lang"), F.explode(flat).alias("e"))
            .groupBy("lang", F.col("e.k").alias("k")).agg(F.sum(F.col("e.n").cast("long")).alias("n")).collect())
    out = References(words=words)
    for name in sorted({r["lang"] for r in rows}):
        chars = [0.0] * (len(CLASSES) + 2)
        common = [0.0] * (len(words) + 1)
        for r in rows:
            if r["lang"] == name:
                if r["k"] < 0:
                    chars[-r["k"] - 1] = float(r["n"])
                else:
                    common[r["k"]] = float(r["n"])
        out.chars[name] = [x / max(sum(chars), 1.0) for x in chars]
        out.common[name] = [x / max(sum(common), 1.0) for x in common]
    return out


def _entropy_term(x: float) -> float:
    return x * math.log2(x) if x > 0 else 0.0


def js_distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) of ``array<struct<k, p>>``, all p > 0, from a reference.

    With m = (p + q) / 2 the divergence is (sum p log p + sum q log q) / 2 - sum m log m.
    Entries missing from ``shares`` have m = q / 2, so their part of the last sum is
    known beforehand; visiting an entry takes its own part out again.
    """
    q = F.lit([float(x) for x in reference])
    unseen = F.lit([_entropy_term(x / 2) for x in reference])
    known = sum(_entropy_term(x) for x in reference) / 2 - sum(_entropy_term(x / 2) for x in reference)

    def step(acc, s):
        m = (s["p"] + F.get(q, s["k"])) / 2
        return acc + F.get(unseen, s["k"]) - m * F.log2(m)

    own = F.aggregate(shares, F.lit(0.0), lambda a, s: a + s["p"] * F.log2(s["p"])) / 2
    div = own + F.aggregate(shares, F.lit(known), step)
    return F.when(F.size(shares) > 0, F.sqrt(F.greatest(F.least(div, F.lit(1.0)), F.lit(0.0))))


def _size_class(n_words: Column) -> Column:
    """Binary length of a number, less one; 0 for none."""
    return (F.length(F.bin(F.greatest(n_words, F.lit(1)))) - 1).cast("int")


def _verdict(refs: References, p: QualityParams) -> Column:
    """``struct<char_distance, word_distance, lang, kept>`` of a features row.

    One expression with every shared part bound once, so a filter on it costs no
    more than the column.
    """
    f = F.col(FEATURES)
    nothing = F.lit(None).cast("double")
    if not refs.chars:
        return F.struct(nothing.alias("char_distance"), nothing.alias("word_distance"),
                        F.lit(None).cast("string").alias("lang"), (~f["base_failed"]).alias("kept"))

    def shares(classes, common, n, m):
        by_class = F.filter(F.transform(classes, lambda x, i: F.struct(i.alias("k"), (x / n).alias("p"))), lambda s: s["p"] > 0)
        by_word = F.transform(common, lambda r: F.struct(r["k"].alias("k"), (r["n"] / m).alias("p")))
        return F.struct(by_class.alias("classes"), by_word.alias("common"))

    def nearest(s):
        each = [F.struct(js_distance(s["classes"], refs.chars[name]).alias("c"),
                         js_distance(s["common"], refs.common[name]).alias("w"), F.lit(name).alias("lang")) for name in refs.chars]
        total = lambda e: F.coalesce(e["c"], F.lit(1.0)) + F.coalesce(e["w"], F.lit(1.0))
        return F.array_min(F.transform(F.array(*each), lambda e: F.struct(total(e).alias("s"), e.alias("e"))))["e"]

    n_chars = F.aggregate(f["classes"], F.lit(0), lambda a, x: a + x)
    n_common = F.aggregate(f["common"], F.lit(0), lambda a, r: a + r["n"])

    limits = refs.word_limits or [1.0]
    limit = F.get(F.lit(limits), F.least(_size_class(f["n_words"]), F.lit(len(limits) - 1)))

    def judged(best):
        long_enough = f["n_words"] >= p.guard_words
        far = (best["c"] > p.max_char_distance) | (best["w"] > limit)
        kept = ~f["base_failed"] & ~(long_enough & F.coalesce(far, F.lit(False)))
        return F.struct(best["c"].alias("char_distance"), best["w"].alias("word_distance"), best["lang"].alias("lang"),
                        kept.alias("kept"))

    positive = lambda x: F.greatest(x, F.lit(1))
    of_counts = let(F.struct(positive(n_chars).alias("n"), positive(n_common).alias("m")),
                    lambda c: shares(f["classes"], f["common"], c["n"], c["m"]))
    return let(let(of_counts, nearest), judged)


def word_limits(features: DataFrame, refs: References, p: QualityParams) -> list[float]:
    """By binary length of the number of words, the fence above the word distances of all sound documents."""
    f = F.col(FEATURES)
    judged = features.where(~f["base_failed"] & (f["n_words"] >= p.guard_words)).select(
        _size_class(f["n_words"]).alias("size"), F.floor(_verdict(refs, p)["word_distance"] * 1000).alias("bin"))
    by_size: dict[int, list] = {}
    for r in judged.groupBy("size", "bin").count().orderBy("bin").collect():     # at most 64 x 1,001 rows
        by_size.setdefault(r["size"], []).append((r["bin"] / 1000, r["count"]))

    def quantile(bins, share):
        below, total = 0, sum(n for _, n in bins)
        for at, n in bins:
            below += n
            if below >= share * total:
                return at

    limits, limit = [], 1.0
    for size in range(max(by_size, default=-1) + 1):
        if size in by_size:
            low, high = quantile(by_size[size], 0.25), quantile(by_size[size], 0.75)
            limit = min(limit, max(high + p.fence * (high - low), p.min_word_limit))
        limits.append(limit)
    return limits


def _features_and_references(docs: DataFrame, p: QualityParams, text: str, lang: str,
                             keep: list[str]) -> tuple[DataFrame, References]:
    words = common_words(docs, p, text, lang)
    features = staged(with_features(docs, words, p, text).select(*[quoted(c) for c in keep], FEATURES), "quality")
    refs = references(features, words, lang)
    if refs.chars:
        refs.word_limits = word_limits(features, refs, p)
    return features, refs


def judge(docs: DataFrame, params: QualityParams = QualityParams(), doc_id: str = "doc_id",
          text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: base counts, distances and the verdict ``kept``."""
    narrow = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"),
                         F.col(quoted(lang)).alias("lang"))
    features, refs = _features_and_references(narrow, params, "text", "lang", ["doc_id", "lang"])
    f = f"{FEATURES}."
    return features.withColumn("v", _verdict(refs, params)).select(
        "doc_id", f + "n_words", f + "word_chars", f + "n_symbols", f + "n_dup_lines", f + "n_repeat_words",
        f + "base_failed", "v.kept", F.round("v.char_distance", 6).alias("char_distance"),
        F.round("v.word_distance", 6).alias("word_distance"), F.col("v.lang").alias("nearest_lang"))


def filter_quality(docs: DataFrame, params: QualityParams = QualityParams(),
                   text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that are kept, with their own columns."""
    features, refs = _features_and_references(docs, params, text, lang, docs.columns)
    return features.where(_verdict(refs, params)["kept"]).select(*[quoted(c) for c in docs.columns])
