"""Golden cases: every end-to-end case of the original test suite, on full result sets."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from snapweave import (compact, diff, extract, legend_of, merge, mutation_pairs, mutation_stats,
                       to_date)
from snapweave.functions.mask import attach_legend
from tests.conftest import rows

BASE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.IntegerType())])
EXTRA = T.StructType(BASE.fields + [T.StructField("w", T.StringType())])
MASKED = T.StructType(BASE.fields + [T.StructField("diffmask", T.StringType())])


def frame(spark, data, schema, legend=None):
    df = spark.createDataFrame(data, schema)
    return attach_legend(df, legend) if legend is not None else df


def test_compact_keeps_rows(spark):
    df = frame(spark, [("2", 2)], BASE)
    for cluster in ("range", "none"):
        assert rows(compact(df, 1, cluster=cluster)) == [("2", 2)]


def test_diff_classes(spark):
    a = frame(spark, [("2", 2), ("3", 3)], BASE)
    b = frame(spark, [("4", 4), ("3", 3)], BASE)
    assert rows(diff(a, b), "type", "key", "value") == [
        ("add", "4", 4), ("del", "2", 2), ("kernel", "3", 3)]


def _ma(spark):
    return frame(spark, [("3", 3, "11"), ("4", 4, "01"), ("2", 2, "10")], MASKED, ["a", "b"])


def _mb(spark):
    return frame(spark, [("5", 5, "11"), ("4", 4, "01"), ("2", 2, "01")], MASKED, ["b", "c"])


def test_merge_masked_and_raw(spark):
    d = frame(spark, [("5", 5), ("6", 6)], BASE)
    out = merge({"ma": _ma(spark), "mb": _mb(spark), "d": d})
    assert legend_of(out) == ["a", "b", "c", "d"]
    assert out.columns == ["key", "value", "diffmask"]
    assert rows(out) == sorted([("3", 3, "1100"), ("4", 4, "0110"), ("2", 2, "1010"),
                                ("6", 6, "0001"), ("5", 5, "0111")])


def test_merge_evolved_schema(spark):
    e = frame(spark, [("2", 2, "B"), ("3", 3, None)], EXTRA)
    d = frame(spark, [("5", 5), ("6", 6)], BASE)
    out = merge([("e", e), ("ma", _ma(spark)), ("d", d)])
    assert legend_of(out) == ["a", "b", "d", "e"]
    assert out.columns == ["key", "value", "w", "diffmask"]
    assert rows(out) == rows(spark.createDataFrame([
        ("2", 2, None, "1000"), ("2", 2, "B", "0001"), ("3", 3, None, "1101"),
        ("4", 4, None, "0100"), ("5", 5, None, "0010"), ("6", 6, None, "0010")],
        "key string, value int, w string, diffmask string"))


def test_merge_same_input_twice(spark):
    d = frame(spark, [("5", 5), ("6", 6)], BASE)
    dd = frame(spark, [("5", 5), ("6", 6)], BASE)
    assert rows(merge({"d": d, "dd": dd})) == [("5", 5, "11"), ("6", 6, "11")]


def test_extract(spark):
    assert rows(extract(_ma(spark), "a")) == [("2", 2), ("3", 3)]
    assert rows(extract(_ma(spark), "b")) == [("3", 3), ("4", 4)]


def test_to_date(spark):
    legend = [f"/bi/importdatetime=2014-01-{d}T01_16_16p01_00" for d in (18, 19, 20)]
    schema = T.StructType([T.StructField("diffmask", T.StringType()), T.StructField("value", T.StringType())])
    df = frame(spark, [("001", "B"), ("110", "A")], schema, legend)
    out = to_date(df)
    assert rows(out, "value", "diffmask", "dm_from_datetime", "dm_to_datetime") == [
        ("A", "110", 1390004176000, 1390090576000),
        ("B", "001", 1390090576000, 1390176976000)]
    assert dict((f.name, f.dataType) for f in out.schema.fields)["dm_from_datetime"] == T.LongType()


def test_mutation(spark):
    data = [("3", 3, "10"), ("3", 4, "01"), ("3", 5, "01"), ("8", 4, "10"), ("8", 5, "01"),
            ("4", 4, "01"), ("2", 2, "10")]
    df = frame(spark, data, MASKED, ["a", "b"])
    stats = mutation_stats(df, "key")
    assert [(tuple(r["fields"]), r["diffmaskIn"], r["diffmaskOut"], r["count"])
            for r in stats.orderBy("diffmaskOut").collect()] == [
        (("value",), "01", "01", 1), (("value",), "01", "10", 2)]
    pairs = mutation_pairs(df, "key")
    assert pairs.count() == 3


@pytest.mark.parametrize("ranges", [1, 2, 3, 7, 16])
def test_mutation_any_range_count(spark, ranges):
    data = [("3", 3, "10"), ("3", 4, "01"), ("3", 5, "01"), ("8", 4, "10"), ("8", 5, "01"),
            ("4", 4, "01"), ("2", 2, "10")]
    df = frame(spark, data, MASKED, ["a", "b"])
    got = rows(mutation_stats(df, "key", num_ranges=ranges).selectExpr(
        "array_join(fields, ',') AS f", "diffmaskIn", "diffmaskOut", "count"))
    assert got == [("value", "01", "01", 1), ("value", "01", "10", 2)]
