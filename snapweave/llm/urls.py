"""URL filters: domain rules, and logistic regression on hashed character n-grams.

A rule is a host with a path prefix; it fits the host and its subdomains, and
the longest fitting rule decides.  Other URLs are judged by a logistic
regression over hashed character n-grams of host and path.

The model is trained by gradient descent over a small labelled URL table.  The
weights are always a sum of the training rows, so descent runs on one
coefficient per labelled URL: the products of all labelled URLs are one
aggregate, the descent is one fold over them, and the weights are the
coefficients summed by n-gram.  Every step is a DataFrame expression.

Defined results: a null URL or one without ``://`` has empty host and path, fits
no rule and is judged by the model's intercept alone; repeated rows are judged
alike; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, quoted, staged

# The rules of the query, host/path and verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# The small labelled table: 1 is to be blocked.
LABELLED = (
    ("http://www.cheap-pills.shop/buy/viagra", 1), ("http://best-pills.example/online", 1),
    ("http://discount-pharmacy.example/order", 1), ("http://casino-bonus.example/play", 1),
    ("http://www.online-casino.example/slots", 1), ("http://free-poker.example/win", 1),
    ("http://bet-win-cash.example/bonus", 1), ("http://adult-videos.example/xxx", 1),
    ("http://xxx-cams.example/live", 1), ("http://hot-porn.example/tube", 1),
    ("http://payday-loans.example/fast", 1), ("http://quick-cash-loan.example/apply", 1),
    ("http://replica-watches.example/sale", 1), ("http://cheap-handbags.example/outlet", 1),
    ("http://free-download-crack.example/keygen", 1), ("http://warez-torrent.example/serial", 1),
    ("http://win-free-prize.example/claim", 1), ("http://click-ads.example/track?ad=1", 1),
    ("http://ads.tracker.example/banner", 1), ("http://spam-links.example/buy/cheap", 1),
    ("http://weight-loss-pills.example/diet", 1), ("http://viagra-online.example/cheap", 1),
    ("http://spam-site.example.org/en/1", 1), ("http://casino-royal.example.com/fr/12.html", 1),
    ("http://ads-server.example.org/de/7", 1), ("http://track-ads.example.com/en/55", 1),
    ("http://free-bets-now.example.org/en/3/", 1), ("http://bets-win.example.com/en/90.html", 1),
    ("http://link-farm.example.com/en/442", 1), ("http://cheap-meds-pills.example.org/fr/51", 1),
    ("http://www.garden.example.com/en/5", 0), ("http://blog.harbour.example.org/en/81.html", 0),
    ("http://m.theatre.example.com/fr/640/", 0), ("http://winter.example.org/de/33", 0),
    ("http://kitchen.example.com/en/702.html", 0), ("http://www.farmland.example.org/en/9", 0),
    ("http://another.example.com/en/71", 0), ("http://www.author.example.com/fr/208", 0),
    ("http://youth.example.com/en/15.html", 0), ("http://south.example.org/en/360/", 0),
    ("http://blog.thousand.example.com/de/92", 0), ("http://m.mother.example.org/fr/8", 0),
    ("http://thunder.example.com/en/505?page=2", 0), ("http://nation.example.com/en/27", 0),
    ("http://northern.example.org/fr/131.html", 0), ("http://www.than.example.com/en/64", 0),
    ("http://question.example.com/es/19", 0), ("http://the-house.example.org/en/246", 0),
    ("http://news.example/en/2020/article", 0), ("http://www.city-library.example/books", 0),
    ("http://university.example/research/paper.html", 0), ("http://blog.garden.example/en/12.html", 0),
    ("http://docs.software.example/manual/intro", 0), ("http://museum.example/fr/exhibition", 0),
    ("http://weather.example/de/berlin", 0), ("http://recipes.example/es/soup", 0),
    ("http://en.encyclopedia.example/wiki/history", 0), ("http://school.example/lessons/math", 0),
    ("http://m.train.example/timetable", 0), ("http://travel.example/en/island.html", 0),
    ("http://science.example/journal/volume/3", 0), ("http://health.example/advice/sleep", 0),
    ("http://forum.bikes.example/thread/991", 0), ("http://blog.theatre.example/en/44", 0),
    ("http://music.example/album/7", 0), ("http://archive.example/letters/1890", 0),
    ("http://www.council.example/en/meeting", 0), ("http://photo.nature.example/fr/301", 0),
    ("http://shop.books.example/en/novel", 0), ("http://astronomy.example/stars/map", 0),
)


@dataclass(frozen=True)
class UrlParams:
    grams: tuple[int, ...] = (3, 4, 5)
    buckets: int = 1 << 13
    epochs: int = 600
    rate: float = 0.5
    decay: float = 0.0003
    threshold: float = 0.5
    max_labelled: int = 2000      # refuses more: training keeps all products of labelled URLs


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _grams(text: Column, n: int) -> Column:
    def of(t):
        last = F.length(t) - n + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(t, i, F.lit(n)))) \
            .otherwise(F.array().cast("array<string>"))
    return let(text, of)


def features(host: Column, path: Column, p: UrlParams) -> Column:
    """Sorted distinct n-gram buckets; host and path have marks, so their n-grams differ."""
    lists = []
    for text in (F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.lit("/"), path, F.lit("|"))):
        lists += [_grams(text, n) for n in p.grams]
    known = F.when(host != "", F.concat(*lists)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.transform(known, lambda g: F.pmod(F.xxhash64(g), F.lit(p.buckets)).cast("int")))


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LABELLED), "url string, label int")


def train(labelled: DataFrame, p: UrlParams) -> tuple[list[float], float]:
    """Weights per bucket and intercept, from ``url, label``."""
    rows = labelled.select("label", features(host_of(F.col("url")), path_of(F.col("url")), p).alias("x"))
    one = rows.agg(F.sort_array(F.collect_list(F.struct("x", F.col("label").cast("double").alias("y")))).alias("rows"))
    if labelled.count() > p.max_labelled:
        raise ValueError(f"more than max_labelled={p.max_labelled} labelled URLs")

    def scale(x):
        return 1.0 / F.sqrt(F.size(x) + F.lit(1.0))

    gram = one.withColumn("k", F.transform("rows", lambda a: F.transform(
        "rows", lambda b: F.size(F.array_intersect(a["x"], b["x"])) * scale(a["x"]) * scale(b["x"]) + 1.0)))
    gram = staged(gram, "url-gram")
    zero = F.transform("rows", lambda r: F.lit(0.0))

    def epoch(alpha, _):
        def dot(line):
            return F.aggregate(F.zip_with(line, alpha, lambda k, a: k * a), F.lit(0.0), lambda s, v: s + v)
        return F.transform("rows", lambda r, i: F.get(alpha, i) * (1 - p.decay) + p.rate * (
            r["y"] - 1.0 / (1.0 + F.exp(-dot(F.get(F.col("k"), i))))))

    trained = gram.withColumn("alpha", F.aggregate(F.sequence(F.lit(1), F.lit(p.epochs)), zero, epoch))
    parts = staged(trained.select(F.posexplode("rows").alias("i", "r"), "alpha").select(
        "r.x", F.get("alpha", F.col("i")).alias("a")), "url-weights")
    bias = parts.agg(F.coalesce(F.sum("a"), F.lit(0.0))).first()[0]
    weights = [0.0] * p.buckets
    summed = (parts.select((F.col("a") * scale(F.col("x"))).alias("w"), F.explode("x").alias("b"))
              .groupBy("b").agg(F.sum("w").alias("w")))
    for r in summed.collect():  # at most one row for each bucket
        weights[r["b"]] = round(r["w"], 9)
    return weights, round(bias, 9)


def probability(x: Column, model: tuple[list[float], float]) -> Column:
    weights, bias = model
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(x, F.lit(0.0), lambda s, b: s + F.get(table, b))
    return 1.0 / (1.0 + F.exp(-(F.lit(bias) + total / F.sqrt(F.size(x) + F.lit(1.0)))))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # the last, longest one wins
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def judge_urls(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, params: UrlParams = UrlParams(),
               page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, probability``."""
    model = train(labelled if labelled is not None else labelled_urls(pages.sparkSession), params)
    parsed = pages.select(F.col(quoted(page_id)).alias("page_id"), host_of(F.col(quoted(url))).alias("host"),
                          path_of(F.col(quoted(url))).alias("path"))
    scored = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "probability", F.round(probability(features(F.col("host"), F.col("path"), params), model), 6))
    verdict = F.when(F.col("probability") > params.threshold, "block").otherwise("allow")
    for rule, says in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(says)).otherwise(verdict)
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "probability")
