"""PII: base patterns, widened by bootstrapped contextual extraction.

Base spans (email, ip, card, phone) come from fixed patterns with their checks.
Each, whole and with the spaces inside it, is a seed under its context: the two
words before it, or what there is at the start of the text.  Contexts with
enough distinct seeds of one kind may be patterns.  Every other place under such a
context is an instance too: a word without the punctuation around it, or, where
words with a digit follow one another, the whole run of them.  Instances and
patterns form a graph.  A pattern's score for a kind is the mean belief of its
distinct instances: 1 for a seed of the kind, 0 for one of another, and for any other
instance the noisy-or of its *other* patterns' scores, so that no pattern vouches
for itself.  Scores start from the seeds alone and rise until they change by less
than a tolerance.  Patterns of high score extract their other instances as further
spans of the same kind.

Seeds must be at least ``min_seeds`` of a pattern's distinct instances.  That rule is
checked before any span is made, in exact steps: words without a digit or @ sign
are never seeds, and the marks they leave in a bitmap of fixed width, first over one
text in sixteen and then over all, are no more than the distinct ones; then they are counted.  So contexts of everyday words go early,
and spans, graph and rounds are about as large as the seeds.

Counts are of distinct instances, so copies of a passage do not add weight, and
every join is on contexts or token texts that are aggregated first.

Defined results: a null or empty text has no spans; repeated rows have the same
spans; extracted spans never overlap base spans; an empty table gives an empty
result; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, match_spans, quoted, staged

# The kinds in report order with their patterns.  They find the same
# matches as the plain forms, but start only where a run starts or the last match
# ended and never give back what they took, so long runs cost linear time.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
EDGE = r"[\p{Punct}&&[^+]]"


@dataclass(frozen=True)
class PiiParams:
    min_support: int = 5          # distinct seeds of a pattern
    min_score: float = 0.9
    min_seeds: float = 0.5        # share of seeds among a pattern's distinct instances
    tolerance: float = 1e-4       # of scores between rounds
    context_chars: int = 80       # a longer pair of words counts by its digest


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Digit sum test over a short digit string."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(
        c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.aggregate(F.filter(each, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        n = F.length(_digits(value))
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _context(two: Column, one: Column, p: PiiParams) -> Column:
    """The two words before a place; a word missing at the start of the text is empty."""
    words = F.lower(F.concat(F.coalesce(two, F.lit("")), F.lit(" "), F.coalesce(one, F.lit(""))))
    return F.when(F.length(words) > p.context_chars, F.sha2(words, 256)).otherwise(words)


def seed_spans(text: Column, p: PiiParams) -> Column:
    """``array<struct<kind, start, stop, token, context>>`` of the base spans by kind, then start."""
    marks = {"email": "@", "ip": ".", "card": None, "phone": "+"}

    def of(number: int, kind: str):
        def each(spans):
            def seed(s, i):
                # the two words before lie in the piece before, or are the matches before that
                one, two = F.get(spans, i - 1), F.get(spans, i - 2)
                before = F.concat_ws("", two["piece"], two["value"], one["piece"], one["value"], s["piece"])
                open_ = F.regexp_replace(before, rf"(?<![^\x20\x09-\x0D]){EDGE}++$", "")
                words = F.array_remove(F.split(open_, SPACE), "")
                return F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("token"),
                                let(words, lambda w: _context(F.get(w, F.size(w) - 2), F.get(w, F.size(w) - 1), p)).alias("context"))
            return F.filter(F.transform(spans, lambda s, i: F.when(valid(kind, s["value"]), seed(s, i))), lambda s: s.isNotNull())
        return let(match_spans(text if marks[kind] is None else F.when(text.contains(marks[kind]), text), PATTERNS[kind]), each)

    return F.concat(*[of(number, kind) for number, kind in enumerate(KINDS)])


def base_spans(text: Column) -> Column:
    """``array<struct<kind int, start, stop>>`` by kind, then start."""
    return _places(seed_spans(text, PiiParams()))


def _places(seeds: Column) -> Column:
    return F.transform(seeds, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))


def contexts(text: Column, p: PiiParams) -> Column:
    """The context of each word, in order."""
    return let(F.array_remove(F.split(text, SPACE), ""), lambda w: F.transform(
        w, lambda _, i: _context(F.get(w, i - 2), F.get(w, i - 1), p)))


def instances(text: Column, hits: Column) -> Column:
    """``array<struct<start, stop, token, context>>`` at ``hits``, an array of ``struct<i, context>`` by word number."""
    def length(parts, n):
        return F.length(F.array_join(F.slice(parts, F.lit(1), n), ""))

    def of(t):
        def instance(h):
            # a run of words with a digit counts as one instance where it starts
            inside = F.substring(t["digits"], h["i"], F.lit(1)) == "1"
            run = F.length(F.regexp_extract(F.substring(t["digits"], h["i"] + 1, F.length(t["digits"])), "^1*+", 0))
            n = F.when((h["i"] > 0) & inside, F.least(run, F.lit(1))).otherwise(run)
            last = h["i"] + F.greatest(n, F.lit(1))
            start = length(t["words"], h["i"]) + length(t["gaps"], h["i"] + 1)
            stop = length(t["words"], last) + length(t["gaps"], last)
            return let(F.struct(start.alias("start"), stop.alias("stop"), h["context"].alias("context")), trimmed)

        def trimmed(s):
            open_ = F.regexp_replace(F.substring(text, s["start"] + 1, s["stop"] - s["start"]), f"^{EDGE}++", "")
            token = F.regexp_replace(open_, rf"(?<!{EDGE}){EDGE}++$", "")
            return let(F.struct((s["stop"] - F.length(open_)).alias("start"), token.alias("token")), lambda x: F.struct(
                x["start"].alias("start"), (x["start"] + F.length(x["token"])).alias("stop"),
                x["token"].alias("token"), s["context"].alias("context")))

        return F.transform(hits, instance)

    words = F.array_remove(F.split(text, SPACE), "")
    digits = F.array_join(F.transform(words, lambda w: F.when(w.rlike("[0-9]"), "1").otherwise("0")), "")
    parts = F.struct(words.alias("words"), F.split(text, WORD).alias("gaps"), digits.alias("digits"))
    return F.filter(let(parts, of), lambda t: t["stop"] > t["start"])


def supported(seeds: DataFrame, p: PiiParams) -> DataFrame:
    """``context, kind, support, seeds`` of contexts with enough distinct seeds, from distinct ``context, token, seed``."""
    counts = seeds.groupBy("context", F.col("seed").alias("kind")).agg(F.count("*").alias("support"))
    everything = seeds.groupBy("context").agg(F.count_distinct("token").alias("seeds"))
    return counts.where(F.col("support") >= p.min_support).join(everything, "context")


MARKS = 4                 # longs of a context's bitmap
FIRST = 16                # one text in so many gives the first bound


def plain_word(word: Column) -> Column:
    """A word without the punctuation around it; null where it may touch a base span or nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(word, f"^{EDGE}++", ""), rf"(?<!{EDGE}){EDGE}++$", "")
    return F.when(~word.rlike("[0-9@]") & (bare != ""), bare)


def places(docs: DataFrame, key: Column, mark: Column, body: Column, p: PiiParams) -> DataFrame:
    """``__id, __v, i, context, word`` of every word."""
    words = F.array_remove(F.split(body, SPACE), "")
    return docs.select(key, mark, F.posexplode(F.arrays_zip(contexts(body, p).alias("context"), words.alias("word"))).alias("i", "z")) \
        .select("__id", "__v", "i", F.col("z.context").alias("context"), F.col("z.word").alias("word"))


def marked_few(words: DataFrame, support: DataFrame, p: PiiParams) -> DataFrame:
    """Rows of ``support`` whose context's words mark few enough bits for its seeds."""
    met = words.join(support.select("context").distinct(), "context").select("context", plain_word(F.col("word")).alias("w")).where("w IS NOT NULL")
    bit = F.pmod(F.xxhash64("w"), F.lit(64 * MARKS)).cast("int")
    marks = [F.bit_or(F.when(F.floor(F.col("b") / 64) == k, F.expr("shiftleft(1L, b % 64)"))).alias(f"m{k}") for k in range(MARKS)]
    marked = met.select("context", bit.alias("b")).groupBy("context").agg(*marks)
    fewest = marked.select("context", sum(F.coalesce(F.bit_count(f"m{k}"), F.lit(0)) for k in range(MARKS)).alias("words"))
    return _enough(support, fewest, p)


def _enough(support: DataFrame, words: DataFrame, p: PiiParams) -> DataFrame:
    """``support`` without the contexts that have too many other instances, given ``context, words`` (at least so many)."""
    share = F.col("support") >= p.min_seeds * (F.col("seeds") + F.coalesce("words", F.lit(0)))
    return support.join(words, "context", "left").where(share).drop("words")


def confident_patterns(edges: DataFrame, support: DataFrame, p: PiiParams) -> DataFrame:
    """``context, kind`` of high score, from distinct ``context, token, seed`` (seed: kind or null)."""
    sizes = edges.groupBy("context").agg(F.count("*").alias("size"))
    kept = support.join(sizes, "context").where(F.col("support") >= p.min_seeds * F.col("size"))
    scores = staged(kept.select("context", "kind", "support", "size", (F.col("support") / F.col("size")).alias("score")), "pii-scores")
    loose = staged(edges.where("seed IS NULL").select("context", "token").join(scores.select("context", "kind"), "context"), "pii-graph")

    def miss(score):
        return F.log(F.greatest(1.0 - score, F.lit(1e-12)))

    while True:
        now = loose.join(scores.select("context", "kind", "score"), ["context", "kind"]).withColumn("miss", miss(F.col("score")))
        all_ = now.groupBy("token", "kind").agg(F.sum("miss").alias("total"))
        # its own share taken out, so only other patterns speak for an instance
        belief = now.join(all_, ["token", "kind"]).groupBy("context", "kind").agg(
            F.sum(F.greatest(1.0 - F.exp(F.least(F.col("total") - F.col("miss"), F.lit(0.0))), F.lit(0.0))).alias("belief"))
        raised = scores.select("context", "kind", "support", "size", F.col("score").alias("before")).join(belief, ["context", "kind"], "left")
        score = F.greatest("before", (F.col("support") + F.coalesce("belief", F.lit(0.0))) / F.col("size"))
        scores = staged(raised.withColumn("score", score), "pii-scores")
        change = scores.agg(F.max(F.col("score") - F.col("before"))).first()[0]
        if not change or change < p.tolerance:
            return scores.where(F.col("score") >= p.min_score).select("context", "kind")


def find_pii(docs: DataFrame, params: PiiParams = PiiParams(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, base, spans``, arrays of ``struct<kind, start, stop>`` by kind, then start."""
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    version = F.xxhash64(body).alias("version")
    held = staged(docs.select(F.col(quoted(doc_id)).alias("doc_id"), version, seed_spans(body, params).alias("seeds")), "pii")

    seeds = staged(held.select(F.explode("seeds").alias("s")).select("s.context", "s.token", F.col("s.kind").alias("seed"))
                   .groupBy("context", "token").agg(F.min("seed").alias("seed")), "pii-seeds")
    # staged, as several joins read it
    support = staged(supported(seeds, params), "pii-support")
    key, mark = F.col(quoted(doc_id)).alias("__id"), F.xxhash64(body).alias("__v")
    words = places(docs, key, mark, body, params)
    # words of some texts are no more than those of all, so they bound every context from below:
    # everyday contexts go before all texts are met, and what stays is decided over all
    some = places(docs.where(F.pmod(F.xxhash64(F.lit(6), body), F.lit(FIRST)) == 0), key, mark, body, params)
    support = staged(marked_few(some, support, params), "pii-marked")
    support = staged(marked_few(words, support, params), "pii-marked")
    # places alone first, so that spans are made only of the words under a pattern that may score
    met = staged(words.join(support.select("context").distinct(), "context"), "pii-places")
    plain = met.select("context", plain_word(F.col("word")).alias("w")).where("w IS NOT NULL").distinct().groupBy("context").agg(F.count("*").alias("words"))
    support = staged(_enough(support, plain, params), "pii-support")
    hits = (met.join(support.select("context").distinct(), "context")
            .groupBy("__id", "__v").agg(F.collect_set(F.struct("i", "context")).alias("hits")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("version") == F.col("__v"))
    texts = docs.select(F.col(quoted(doc_id)).alias("doc_id"), version, body.alias("text"))
    found = (texts.join(staged(hits, "pii-hits"), same).select("doc_id", "version", F.explode(instances(F.col("text"), F.col("hits"))).alias("t"))
             .groupBy("doc_id", "version").agg(F.collect_set("t").alias("found"))
             .withColumnsRenamed({"doc_id": "__id", "version": "__v"}))
    off_base = held.join(found, same).select("doc_id", "version", F.filter("found", lambda t: ~F.exists(
        "seeds", lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"]))).alias("found"))
    loose = staged(off_base.select("doc_id", "version", F.explode("found").alias("t")).select("doc_id", "version", "t.*"), "pii-instances")
    edges = staged(seeds.unionByName(loose.select("context", "token", F.lit(None).cast("int").alias("seed")))
                   .groupBy("context", "token").agg(F.min("seed").alias("seed")), "pii-edges")
    patterns = confident_patterns(edges, support, params)
    more = (loose.join(patterns, "context").groupBy("doc_id", "version")
            .agg(F.collect_set(F.struct("kind", "start", "stop")).alias("more"))
            .withColumnsRenamed({"doc_id": "__id", "version": "__v"}))
    free = F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,stop:int>>"))
    return held.join(more, same, "left").select("doc_id", _places(F.col("seeds")).alias("base"), free.alias("more")) \
        .select("doc_id", "base", F.sort_array(F.concat("base", "more")).alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:stop`` comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
