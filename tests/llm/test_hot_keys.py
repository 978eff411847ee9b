"""Joins on keys that may be hot: the plan splits the hot key's rows over tasks."""

import pytest
from pyspark.sql import functions as F

from snapweave.llm import line_dedup, warc

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def hot(spark):
    """Settings under which a few thousand equal keys are already a skewed partition."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark.range(0, 60_000, 1, 8)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def is_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_payload(hot):
    pages = hot.select(F.col("id").alias("page_id"), F.lit("http://a.example/").alias("url"),
                       F.when(F.col("id") % 10 != 0, "same").otherwise(F.col("id").cast("string")).alias("html"))
    decided = warc._decisions(warc._records(pages, "page_id", "url", "html"), warc.WarcParams())
    assert decided.where("refers_to IS NOT NULL").count() == 53_999
    assert is_split(decided)


def test_hot_half_of_lines(hot):
    keys = hot.select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id")).alias("key"))
    shared = line_dedup._shared(keys)
    assert shared.count() == 20_000
    assert is_split(shared)
