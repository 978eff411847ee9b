"""One query per operator: each applies it, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, langid, line_dedup, mixing, pii, quality, simhash, spelling, token_counts, toxicity, urls,
               warc, whitening)
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that repeat an earlier line, or are one edit from it."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"), min_chars=1)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances from the language references, and the verdict."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, counted between separators of flat token files."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document; the fold with remainder 2 is never learned from."""
    docs = table(spark, sf_dir, "documents")
    params = langid.LanguageParams()
    learned = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))), params)
    found = langid.identify(docs, learned, params)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data: counts and digest of the base spans, and all spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[pii.count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes, and the shards that get them."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and the smallest id of its group."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on each page's URL."""
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document after deobfuscation; the fold with remainder 0 teaches no label."""
    docs = table(spark, sf_dir, "documents")
    params = toxicity.ToxicityParams()
    scored = toxicity.score_texts(docs, toxicity.learn(docs, table(spark, sf_dir, "labels"), params), params)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents with their near words, the form each is a variant of, and the last form."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding along the 16 directions of most variance, scaled to variance one."""
    return whitening.whitened_embeddings(table(spark, sf_dir, "embeddings"), components=16)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_quality_rules, op3_token_counts, op4_language_id, op5_decontamination,
                            op6_pii, op7_mixing, op8_simhash, op9_url_filter, op10_warc, op11_toxicity, op12_spelling_variants,
                            op13_whitening)}

ORACLES: dict[str, str] = {
    "op5_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM s),
sizes AS (SELECT DISTINCT n FROM win),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM p JOIN win ON win.n = p.n AND win.t = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
