"""Merge of one labelled frame: equal to merge, at any legend length, in a plan of constant width."""

import random

import pytest
from pyspark.sql import functions as F

from snapweave import extract, legend_of, merge, merge_labelled, to_date
from tests.conftest import rows
from tests.inspect_plan import exchanges, physical_plan

SCHEMA = "day string, a int, `b.c` string, __word double"


def _labelled(spark, seed, labels, n=200):
    r = random.Random(seed)
    return spark.createDataFrame([(r.choice(labels), r.choice([None, 0, 1]), r.choice([None, "x", "y"]),
                                   r.choice([None, 0.5, float("nan")])) for _ in range(n)], SCHEMA)


def _apart(df, labels):
    return {x: df.where(F.col("day") == x).drop("day") for x in labels}


@pytest.mark.parametrize("n", [1, 3, 63, 64, 130])
def test_equals_merge(spark, n):
    labels = [f"d{i:04d}" for i in range(n)]
    df = _labelled(spark, n, labels)
    found = merge_labelled(df, "day", labels=labels)
    want = merge(_apart(df, labels))
    assert found.columns == want.columns and legend_of(found) == legend_of(want) == labels
    assert str(rows(found)) == str(rows(want))


@pytest.mark.parametrize("old, new", [(range(0, 70), range(70, 90)), (range(0, 140, 2), range(1, 140, 2)), (range(5, 9), range(0, 80))])
def test_history_is_realigned(spark, old, new):
    old, new = [[f"d{i:04d}" for i in part] for part in (old, new)]
    before, after = _labelled(spark, 1, old), _labelled(spark, 2, new)
    history = merge_labelled(before, "day", labels=old)
    found = merge_labelled(after, "day", history=history, labels=new)
    want = merge_labelled(before.unionByName(after), "day", labels=sorted({*old, *new}))
    assert legend_of(found) == legend_of(want) and str(rows(found)) == str(rows(want))


def test_five_thousand_imports_in_a_plan_of_constant_width(spark):
    def plan(n):
        df = spark.range(40_000).select(F.format_string("importdatetime=%05d", F.col("id") % n).alias("day"), (F.col("id") % 7).alias("k"))
        return merge_labelled(df, "day", labels=[f"importdatetime={i:05d}" for i in range(n)])
    small, large = plan(50), plan(5000)
    shapes = [[line.split("[")[0].split("(")[0] for line in physical_plan(d).splitlines()] for d in (small, large)]
    assert len(shapes[0]) == len(shapes[1]) and exchanges(large) == exchanges(small)
    found = {r["k"]: r["diffmask"] for r in large.collect()}
    want = {k: {i % 5000 for i in range(k, 40_000, 7)} for k in range(7)}
    assert {k: {i for i, c in enumerate(m) if c == "1"} for k, m in found.items()} == want
    assert {len(m) for m in found.values()} == {5000}
    one = extract(large, "importdatetime=02500")
    assert sorted(r["k"] for r in one.collect()) == sorted(k for k in want if 2500 in want[k])


def test_edges(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("c", None)], "day string, k int")
    got = {r["k"]: r["diffmask"] for r in merge_labelled(df, "day", labels=["a", "b", "c"]).collect()}
    assert got == {1: "100", None: "001"}                    # an import without rows, copies, nulls
    none = merge_labelled(df.limit(0), "day", labels=["a"])
    assert none.collect() == [] and legend_of(none) == ["a"]
    zero = merge({"a": df.where("day = 'a'").drop("day")}).select("k", F.lit("0").alias("diffmask", metadata={"diffdirs": ["a"]}))
    kept = merge_labelled(df.limit(0), "day", history=zero, labels=["b"]).collect()
    assert [(r["k"], r["diffmask"]) for r in kept] == [(1, "00")]   # a history's all-zero record stays
    with pytest.raises(ValueError, match="at least one"):
        merge_labelled(df.limit(0), "day")
    with pytest.raises(ValueError, match="no column"):
        merge_labelled(df, "night")
    with pytest.raises(ValueError, match="history"):
        merge_labelled(zero, "k")
    for bad in (spark.createDataFrame([(None, 1)], "day string, k int"), df):
        with pytest.raises(Exception, match="no listed import"):
            merge_labelled(bad, "day", labels=["a"]).collect()


def test_dates_of_a_labelled_merge(spark):
    label = "importdatetime=2014-01-{:02d}T00_00_00p00_00"
    df = spark.createDataFrame([(label.format(d), 1) for d in range(3, 6)] + [(label.format(1), 2)], "day string, k int")
    dated = {r["k"]: (r["dm_from_datetime"], r["dm_to_datetime"]) for r in to_date(merge_labelled(df, "day")).collect()}
    apart = {x: df.where(F.col("day") == x).drop("day") for x in sorted({r["day"] for r in df.collect()})}
    assert dated == {r["k"]: (r["dm_from_datetime"], r["dm_to_datetime"]) for r in to_date(merge(apart)).collect()}
