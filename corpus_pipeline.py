"""The corpus pipeline: five stages over ``documents``, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept.  Stages return the columns of documents; the last adds the output shard.

1. quality rules: documents that fail the base rules or lie far from every
   language reference go;
2. line dedup: lines of any length that are equal to an earlier line or one edit
   from it are cut out of the texts, and a document without a word left goes;
3. SimHash: of each group of near-duplicates the document of smallest id stays;
4. decontamination: stretches shared with benchmark items are cut out, and
   documents mostly made of them go;
5. mixing: documents are repeated or left out towards their source's target.

``n_chars`` follows the text where a stage changes it.  ``ORACLE_SQL`` is None:
stages 1, 3 and 5 rest on learned references, group search and hash draws that
SQL does not express; tests compare the stages with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.llm import decontaminate, line_dedup, mixing, quality, simhash
from snapweave.llm.common import table
from snapweave.sources.stage import stage_path

ORACLE_SQL = None


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_dedup.dedup_lines(docs, min_chars=1))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup_stage),
          ("simhash near-dedup", simhash_near_dedup), ("benchmark decontamination", benchmark_decontamination),
          ("mixing", mixing_to_targets)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder and reread."""
    root = stage_path(spark, "llm-pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
