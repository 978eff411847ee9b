"""Reader schemas: part files of several schemas, defaults of every kind, names and masks that must not be misread."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave import (diff, extract, legend_of, merge, mutation_pairs, mutation_stats, nearest_label, read_snapshot, to_date,
                       write_output)
from snapweave.operators import mutation
from snapweave.sources.schemas import avro_record, load_schema
from snapweave.sources.snapshots import schema_groups
from tests.conftest import rows

LABELS = ["/d/importdatetime=2014-01-18T01_16_16p01_00", "/d/importdatetime=2014-01-19T01_16_16p01_00"]


def one(spark, sql, path):
    spark.sql(sql).write.mode("append").parquet(path)


@pytest.mark.parametrize("seed", range(8))
def test_no_value_is_lost_over_mixed_files(spark, tmp_path, seed):
    path = str(tmp_path / f"snap{seed}")
    parts = ["select 1 id", "select 2 id, 'x' extra", "select cast(3 as bigint) id, cast(null as string) extra", "select 4 id, 'y' extra, 1.5D more"]
    for sql in parts[seed % 4:] + parts[:seed % 4]:
        one(spark, sql, path)
    assert rows(read_snapshot(spark, path), "id", "extra", "more") == [(1, None, None), (2, "x", None), (3, None, None), (4, "y", 1.5)]
    got = read_snapshot(spark, path, schema="id bigint, extra string")
    assert rows(got) == [(1, None), (2, "x"), (3, None), (4, "y")]


def test_a_default_fills_only_files_without_the_column(spark, tmp_path):
    path = str(tmp_path / "snap")
    one(spark, "select 1 id", path)
    one(spark, "select 2 id, cast(null as string) extra", path)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("extra", T.StringType(), True, {"default": "d"})])
    assert rows(read_snapshot(spark, path, schema=schema)) == [(1, "d"), (2, None)]


def test_files_of_one_schema_are_read_together(spark, tmp_path):
    path = str(tmp_path / "snap")
    spark.range(100).repartition(7).write.parquet(path)
    one(spark, "select cast(100 as bigint) id, 1 b", path)
    groups = schema_groups(spark, spark.read.parquet(path).inputFiles())
    assert sorted(map(len, groups)) == [1, 7] and read_snapshot(spark, path).count() == 101


def test_mixed_partitions_and_legend_are_kept(spark, tmp_path):
    masked = merge({LABELS[0]: spark.sql("select 1 id"), LABELS[1]: spark.sql("select 2 id")})
    path = str(tmp_path / "masked")
    write_output(masked, path)
    write_output(masked.withColumn("more", F.lit(1)), path, mode="append")
    back = read_snapshot(spark, path)
    assert legend_of(back) == LABELS and back.count() == 4 and extract(back, LABELS[0]).count() == 2
    split = str(tmp_path / "split")
    one(spark, "select 1 id", f"{split}/type=add")
    one(spark, "select 2 id, 'x' more", f"{split}/type=del")
    assert rows(read_snapshot(spark, split), "id", "type", "more") == [(1, "add", None), (2, "del", "x")]


def field(kind, default):
    return {"name": "f", "type": kind, "default": default}


@pytest.mark.parametrize("kind, default, want", [
    ({"type": "int", "logicalType": "date"}, 20, "1970-01-21"),
    ({"type": "long", "logicalType": "timestamp-millis"}, 1000, "1970-01-01 00:00:01"),
    ({"type": "long", "logicalType": "timestamp-micros"}, 1500000, "1970-01-01 00:00:01.5"),
    ({"type": "long", "logicalType": "local-timestamp-millis"}, -1, "1969-12-31 23:59:59.999"),
    ({"type": "long", "logicalType": "local-timestamp-micros"}, 1, "1970-01-01 00:00:00.000001"),
    ({"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}, "\u0001\u0000", "2.56"),
    ({"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}, "ÿ", "-0.01"),
    ("string", "text", "text"), ("int", 5, "5"), ("boolean", True, "true"), ("double", 0.5, "0.5"),
    ({"type": "enum", "name": "e", "symbols": ["A", "B"]}, "B", "B"),
    (["string", "null"], "text", "text"), (["int", "long"], 7, "7"), (["null", "string"], None, None),
    (["int", "string"], 5, "{5, null}"),
    ({"type": "array", "items": {"type": "int", "logicalType": "date"}}, [1, 2], "[1970-01-02, 1970-01-03]"),
    ({"type": "map", "values": "int"}, {"a": 1}, "{a -> 1}"),
    ({"type": "record", "name": "r", "fields": [{"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}}]},
     {"t": 5000}, "{1970-01-01 00:00:05}")])
def test_every_kind_of_default(spark, tmp_path, kind, default, want):
    path = str(tmp_path / "snap")
    one(spark, "select 1 id", path)
    spec = tmp_path / "s.avsc"
    spec.write_text(json.dumps({"type": "record", "name": "row", "fields": [{"name": "id", "type": "int"}, field(kind, default)]}))
    got = read_snapshot(spark, path, schema=load_schema(str(spec))).select(F.col("f").cast("string").alias("f")).first()["f"]
    assert got == want


def test_unions_of_several_types():
    schema = avro_record({"type": "record", "name": "r", "fields": [
        {"name": "a", "type": ["null", "int", "string"]}, {"name": "b", "type": ["int", "long"]}, {"name": "c", "type": ["float", "null", "double"]}]}, member_structs=True)
    assert schema.simpleString() == "struct<a:struct<member0:int,member1:string>,b:bigint,c:double>"
    assert [f.nullable for f in schema.fields] == [True, False, True]


def test_a_default_beside_a_diff(spark, tmp_path):
    schema = avro_record({"type": "record", "name": "r", "fields": [
        {"name": "id", "type": "int"}, {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}, "default": 1000}]})
    one(spark, "select 1 id", str(tmp_path / "a"))
    one(spark, "select 1 id, timestamp'1970-01-01 00:00:01' t", str(tmp_path / "b"))
    a, b = (read_snapshot(spark, str(tmp_path / x), schema=schema) for x in "ab")
    assert [r["type"] for r in diff(a, b).collect()] == ["kernel"]


def masked(spark, mask):
    from snapweave.functions.mask import attach_legend
    return attach_legend(spark.createDataFrame([("1", mask)], "key string, diffmask string"), LABELS)


@pytest.mark.parametrize("mask", ["001", "1", ""])
def test_a_mask_of_another_length_raises(spark, mask):
    for run in (to_date, lambda m: extract(m, LABELS[0]), lambda m: extract(m, LABELS[1])):
        with pytest.raises(Exception, match="a mask of the legend's 2 snapshots is expected"):
            run(masked(spark, mask)).collect()


def test_data_columns_named_like_helpers(spark, monkeypatch):
    frames = {LABELS[0]: spark.sql("select id % 3 k, id v, id __w0, 1 rows from range(60)"), LABELS[1]: spark.sql("select id % 3 k, id + 1 v, id __w0, 1 rows from range(60)")}
    merged = merge(frames)
    assert merged.columns == ["k", "v", "__w0", "rows", "diffmask"] and merged.count() == 120
    whole = rows(mutation_stats(merged, "k"))
    assert rows(mutation_stats(merged, "k", hot_key_rows=5)) == whole
    monkeypatch.setattr(mutation, "BROADCAST_BYTES", 1)
    assert rows(mutation_stats(merged, "k", hot_key_rows=5)) == whole
    with pytest.raises(ValueError, match="__key"):
        mutation_pairs(merged.withColumnRenamed("v", "__key"), "k")


@pytest.mark.parametrize("name", ["distance", "nearest_label"])
def test_nearest_label_keeps_data_columns(spark, name):
    df = spark.createDataFrame([("a", 1)], f"label string, {name} int")
    with pytest.raises(ValueError, match=name):
        nearest_label(df, "label", ["a", "b"])
    got = nearest_label(df, "label", ["a", "b"], output="found", distance="far").first()
    assert (got[name], got["found"], got["far"]) == (1, "a", 0)
