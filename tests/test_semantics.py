"""Edge cases the original suite left untested, and unit tests of the mask helpers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave import compact, diff, extract, legend_of, merge, mutation_pairs, to_date
from snapweave.functions.mask import (MaskLayout, attach_legend, first_set, last_set,
                                      realign_words, render_mask)
from snapweave.plans.schema import SchemaConflict
from tests.conftest import rows

KV = "key string, value int"


def test_diff_two_copies_in_origin_none_in_dest(spark):
    a = spark.createDataFrame([("1", 1), ("1", 1)], KV)
    b = spark.createDataFrame([("9", 9)], KV)
    assert ("del", "1", 1) in rows(diff(a, b), "type", "key", "value")
    assert ("kernel", "1", 1) in rows(diff(a, b, mode="count"), "type", "key", "value")


def test_diff_two_copies_in_origin_one_in_dest(spark):
    a = spark.createDataFrame([("1", 1), ("1", 1)], KV)
    b = spark.createDataFrame([("1", 1)], KV)
    assert rows(diff(a, b), "type", "key", "value") == [("kernel", "1", 1)]
    assert diff(a, b, mode="count").count() == 0


def test_diff_null_equals_null(spark):
    a = spark.createDataFrame([(None, 1), ("x", None)], KV)
    b = spark.createDataFrame([(None, 1), ("x", None)], KV)
    assert [r[0] for r in rows(diff(a, b), "type")] == ["kernel", "kernel"]


def test_diff_destination_schema_governs(spark):
    a = spark.createDataFrame([("1", 1, "only-in-origin")], "key string, value int, extra string")
    b = spark.createDataFrame([("1", 1)], KV)
    out = diff(a, b)
    assert out.columns == ["key", "value", "type"]
    assert rows(out) == [("1", 1, "kernel")]
    # Destination columns the origin lacks read as null.
    out2 = diff(b.select("key"), b)
    assert rows(out2, "type", "key", "value") == [("add", "1", 1), ("del", "1", None)]


def test_diff_origin_widened_to_destination(spark):
    a = spark.createDataFrame([("1", 1)], KV)
    b = spark.createDataFrame([("1", 1)], "key string, value bigint")
    assert rows(diff(a, b), "type") == [("kernel",)]
    with pytest.raises(SchemaConflict):
        diff(b, a)  # bigint cannot be read as int without loss


def test_compact_keeps_duplicates(spark):
    df = spark.createDataFrame([("1", 1)] * 50 + [("2", 2)] * 3, KV)
    for cluster in ("range", "none"):
        out = compact(df, 4, cluster=cluster)
        assert out.rdd.getNumPartitions() <= 4
        assert rows(out) == rows(df)


def test_range_compact_spreads_identical_copies(spark):
    df = spark.range(4000).select(F.lit("same").alias("key"), F.lit(1).alias("value"))
    sizes = (compact(df, 8, cluster="range").groupBy(F.spark_partition_id().alias("p")).count()
             .collect())
    assert max(r["count"] for r in sizes) < 4000 / 4  # no part holds the whole run


def test_merge_duplicates_inside_snapshot(spark):
    s = spark.createDataFrame([("1", 1), ("1", 1), ("2", 2)], KV)
    assert rows(merge({"a": s})) == [("1", 1, "1"), ("2", 2, "1")]


def test_merge_widens_int_to_long_and_rejects_string(spark):
    a = spark.createDataFrame([("1", 1)], KV)
    b = spark.createDataFrame([("1", 1)], "key string, value bigint")
    out = merge({"a": a, "b": b})
    assert dict(out.dtypes)["value"] == "bigint"
    assert rows(out) == [("1", 1, "11")]
    c = spark.createDataFrame([("1", "1")], "key string, value string")
    with pytest.raises(SchemaConflict):
        merge({"a": a, "c": c})


@pytest.mark.parametrize("n", [1, 62, 63, 64, 100])
def test_masks_of_many_snapshots_round_trip(spark, n):
    labels = [f"s{i:03d}" for i in range(n)]
    # Record j is present in every snapshot i with i % (j + 1) == 0 (record 0 everywhere).
    frames = {}
    for i, label in enumerate(labels):
        keep = [j for j in range(5) if i % (j + 1) == 0]
        frames[label] = spark.createDataFrame([(str(j), j) for j in keep], KV)
    merged = merge(frames).cache()  # re-read by every check below
    assert legend_of(merged) == labels
    expect = {str(j): "".join("1" if i % (j + 1) == 0 else "0" for i in range(n)) for j in range(5)}
    got = {r["key"]: r["diffmask"] for r in merged.collect()}
    assert got == expect
    for i in sorted({0, n // 2, n - 1}):
        assert rows(extract(merged, labels[i])) == rows(frames[labels[i]])
    # Incremental merge (masked input re-laid onto a larger legend) agrees.
    if n > 2:
        half = merge({lab: frames[lab] for lab in labels[: n // 2]})
        rest = {lab: frames[lab] for lab in labels[n // 2:]}
        assert rows(merge({"half": half, **rest})) == rows(merged)
    merged.unpersist()


def test_to_date_all_zero_and_gap(spark):
    legend = [f"/x/importdatetime=2014-01-{d}T00_00_00p00_00" for d in (10, 11, 12)]
    df = attach_legend(spark.createDataFrame([("000", "z"), ("101", "g")], "diffmask string, v string"),
                       legend)
    out = {r["v"]: (r["dm_from_datetime"], r["dm_to_datetime"]) for r in to_date(df).collect()}
    day = 86_400_000
    t10 = 1389312000000
    assert out["z"] == (None, None)
    assert out["g"] == (t10, t10 + 2 * day)


def test_to_date_label_without_time_raises(spark):
    df = attach_legend(spark.createDataFrame([("1",)], "diffmask string"), ["/no/time/here"])
    with pytest.raises(ValueError, match="importdatetime"):
        to_date(df)


def test_to_date_explicit_times(spark):
    df = spark.createDataFrame([("01",)], "diffmask string")
    out = to_date(df, snapshots=["a", "b"], times=[10, 20]).first()
    assert (out["dm_from_datetime"], out["dm_to_datetime"]) == (10, 20)


def test_extract_unknown_label(spark):
    df = attach_legend(spark.createDataFrame([("1", 1, "10"), ("2", 2, "01")],
                                             "key string, value int, diffmask string"),
                       ["/data/2014-01", "/data/2014-02"])
    with pytest.raises(KeyError):
        extract(df, "/data/2014-03")
    assert rows(extract(df, "/data/2014-02x", match="nearest")) == [("2", 2)]
    # Tie (distance 1 to both): lowest legend position wins.
    assert rows(extract(df, "/data/2014-0", match="nearest")) == [("1", 1)]


def test_legend_required(spark):
    df = spark.createDataFrame([("1", "1")], "key string, diffmask string")
    with pytest.raises(ValueError, match="legend"):
        extract(df, "a")
    assert rows(extract(df, "a", snapshots=["a"])) == [("1",)]


def test_mutation_null_key_excluded(spark):
    df = attach_legend(spark.createDataFrame(
        [(None, 1, "10"), (None, 2, "01"), ("k", 1, "10"), ("k", 2, "01")],
        "key string, value int, diffmask string"), ["a", "b"])
    got = [(tuple(r["fields"]), r["diffmaskIn"], r["diffmaskOut"]) for r in mutation_pairs(df, "key").collect()]
    assert got == [(("value",), "01", "10")]


def test_mutation_chronological_order(spark):
    df = attach_legend(spark.createDataFrame(
        [("k", 1, "100"), ("k", 2, "010"), ("k", 3, "001")], "key string, value int, diffmask string"),
        ["a", "b", "c"])
    ref = [(r["diffmaskIn"], r["diffmaskOut"]) for r in mutation_pairs(df, "key").collect()]
    chrono = [(r["diffmaskIn"], r["diffmaskOut"])
              for r in mutation_pairs(df, "key", order="chronological").collect()]
    assert sorted(ref) == [("001", "010"), ("010", "100")]
    assert sorted(chrono) == [("010", "001"), ("100", "010")]


def test_mutation_map_fields(spark):
    df = attach_legend(spark.createDataFrame(
        [("k", {"a": 1}, 1, "10"), ("k", {"a": 2}, 1, "01")],
        "key string, m map<string,int>, v int, diffmask string"), ["a", "b"])
    got = [tuple(r["fields"]) for r in mutation_pairs(df, "key").collect()]
    assert got == [("m",)]


# ---------------------------------------------------------------- mask helpers

def test_layout_positions_of_labels():
    layout = MaskLayout.of(["b", "c", "a"])
    assert [layout.index(x) for x in ["a", "b"]] == [2, 0]


def test_realign_and_render(spark):
    layout = MaskLayout.of(["a", "b", "c", "d"])
    words = realign_words(F.lit("101"), ["a", "c", "d"], layout)
    assert spark.range(1).select(render_mask(words, layout).alias("m")).first()["m"] == "1001"


def test_first_last_set(spark):
    got = spark.createDataFrame([("0000",), ("0110",), ("1001",)], "m string").select(
        "m", first_set(F.col("m")).alias("f"), last_set(F.col("m")).alias("l")).collect()
    assert {r["m"]: (r["f"], r["l"]) for r in got} == {"0000": (0, 0), "0110": (2, 3), "1001": (1, 4)}


def test_layout_rejects_bad_legends():
    with pytest.raises(ValueError):
        MaskLayout.of([])
    with pytest.raises(ValueError):
        MaskLayout.of(["a", "a"])


def test_schema_types_and_order(spark):
    from snapweave.plans.schema import reconcile
    s1 = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("z", T.StringType())])
    s2 = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    out = reconcile([s1, s2])
    # b: last defined at position 1 (long); z keeps position 1 from s1; a at 0.
    assert [(f.name, f.dataType.simpleString()) for f in out.fields] == [
        ("a", "string"), ("b", "bigint"), ("z", "string")]
    assert all(f.nullable for f in out.fields)


def test_labels_with_commas_round_trip(spark, tmp_path):
    labels = ["a,b|1", "c\nd"]
    frames = {labels[0]: spark.createDataFrame([("1", 1)], KV), labels[1]: spark.createDataFrame([("2", 2)], KV)}
    out = str(tmp_path / "m")
    merge(frames).write.parquet(out)
    back = spark.read.parquet(out)
    assert legend_of(back) == sorted(labels)
    assert rows(extract(back, "a,b|1")) == [("1", 1)]


def test_path_value(spark):
    from snapweave.functions import path_value
    got = spark.range(1).select(
        path_value(F.lit("/bi/fromtable=T/importdatetime=X/part"), "fromtable").alias("a"),
        path_value(F.lit("fromtable=T"), "fromtable").alias("b"),
        path_value(F.lit("/x/y"), "fromtable").alias("c")).first()
    assert (got["a"], got["b"], got["c"]) == ("T", "T", "")


def test_empty_snapshot_directory_raises(spark, tmp_path):
    from snapweave import read_snapshot
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA|Unable to infer"):
        read_snapshot(spark, str(empty))


def test_mutation_groups_on_text_of_float_keys(spark):
    df = attach_legend(spark.createDataFrame(
        [(1.5, 1, "10"), (1.5, 2, "01"), (-0.0, 1, "10"), (0.0, 2, "01")],
        "key double, value int, diffmask string"), ["a", "b"])
    for hot in (10**9, 1):
        got = [(tuple(r["fields"]), r["diffmaskIn"], r["diffmaskOut"])
               for r in mutation_pairs(df, "key", hot_key_rows=hot).collect()]
        # -0.0 and 0.0 print differently, so they are different groups: one pair only.
        assert got == [(("value",), "01", "10")]


def test_intervals_as_timestamps(spark):
    from snapweave import intervals
    df = spark.createDataFrame([("01",)], "diffmask string")
    out = intervals(df, snapshots=["a", "b"], times=[0, 86_400_000], as_timestamp=True)
    assert dict(out.dtypes)["dm_to_datetime"] == "timestamp"
    r = out.selectExpr("cast(dm_from_datetime as string) f", "cast(dm_to_datetime as string) t").first()
    assert (r["f"], r["t"]) == ("1970-01-01 00:00:00", "1970-01-02 00:00:00")


def test_nested_types_through_every_job(spark):
    schema = "id int, tags array<string>, attrs struct<a:int,b:string>, props map<string,int>"
    s0 = spark.createDataFrame([(1, ["x"], (1, "p"), {"k": 1}), (2, [], (2, None), {})], schema)
    s1 = spark.createDataFrame([(1, ["x"], (1, "p"), {"k": 1}), (2, ["y"], (2, None), {"k": 2})], schema)
    d = rows(diff(s0, s1), "type", "id")
    assert d == [("add", 2), ("del", 2), ("kernel", 1)]
    merged = merge({"a": s0, "b": s1})
    assert sorted(r["diffmask"] for r in merged.collect()) == ["01", "10", "11"]
    assert extract(merged, "b").count() == 2
    pairs = [(tuple(r["fields"]), r["diffmaskIn"], r["diffmaskOut"])
             for r in mutation_pairs(merged, "id").collect()]
    assert pairs == [(("props", "tags"), "01", "10")]
    split = [(tuple(r["fields"]), r["diffmaskIn"], r["diffmaskOut"])
             for r in mutation_pairs(merged, "id", hot_key_rows=1, num_ranges=2).collect()]
    assert split == pairs
    for cluster in ("range", "none"):
        assert compact(s1, 2, cluster=cluster).count() == 2


def test_float_zero_signs_and_nan_compare_equal(spark):
    """Documented choice: Spark grouping treats -0.0 = 0.0 and NaN = NaN."""
    a = spark.createDataFrame([(-0.0,), (float("nan"),)], "x double")
    b = spark.createDataFrame([(0.0,), (float("nan"),)], "x double")
    assert sorted(r["type"] for r in diff(a, b).collect()) == ["kernel", "kernel"]
    assert merge({"a": a, "b": b}).count() == 2


def test_negative_offsets_need_explicit_times(spark):
    """Only 'p' (plus) has a spelling in labels; other offsets take times=."""
    legend = ["/x/importdatetime=2014-01-10T00_00_00m05_00", "/x/importdatetime=2014-01-11T00_00_00m05_00"]
    df = attach_legend(spark.createDataFrame([("11",)], "diffmask string"), legend)
    with pytest.raises(ValueError, match="importdatetime"):
        to_date(df)
    out = to_date(df, times=[1, 2]).first()
    assert (out["dm_from_datetime"], out["dm_to_datetime"]) == (1, 2)


def test_mutation_strategies_agree_on_special_doubles(spark):
    nan = float("nan")
    data = [("k", v, m) for v in (nan, -0.0, 0.0, 1.5, None, nan) for m in ("01", "10", "11")]
    df = attach_legend(spark.createDataFrame(data, "key string, x double, diffmask string"), ["a", "b"])

    def run(hot, ranges):
        return sorted(map(tuple, mutation_pairs(df, "key", hot_key_rows=hot, num_ranges=ranges)
                          .selectExpr("array_join(fields, ',')", "diffmaskIn", "diffmaskOut").collect()))

    window = run(10**9, None)
    assert len(window) == len(data) - 1
    for ranges in (1, 2, 3, 5):
        assert run(1, ranges) == window


def test_to_date_keeps_the_legend(spark):
    legend = [f"/x/importdatetime=2014-01-{d}T00_00_00p00_00" for d in (10, 11)]
    df = attach_legend(spark.createDataFrame([("10",)], "diffmask string"), legend)
    assert legend_of(to_date(df)) == legend


def test_mutation_stats_with_more_fields_than_one_word(spark):
    from snapweave import mutation_stats
    names = [f"c{i:02d}" for i in range(70)]
    base = {n: 0 for n in names}
    v1 = dict(base, key="k", diffmask="10")
    v2 = dict(base, key="k", diffmask="01", c02=1, c65=1, c69=1)
    cols = ["key"] + names + ["diffmask"]
    schema = ", ".join(["key string"] + [f"{n} int" for n in names] + ["diffmask string"])
    rows_ = [tuple(v[c] for c in cols) for v in (v1, v2)]
    df = attach_legend(spark.createDataFrame(rows_, schema), ["a", "b"])
    got = [(tuple(r["fields"]), r["diffmaskIn"], r["diffmaskOut"], r["count"])
           for r in mutation_stats(df, "key").collect()]
    assert got == [(("c02", "c65", "c69"), "01", "10", 1)]
    split = [(tuple(r["fields"]), r["count"]) for r in mutation_stats(df, "key", hot_key_rows=1).collect()]
    assert split == [(("c02", "c65", "c69"), 1)]


def test_extract_at_position(spark):
    from snapweave import extract_at
    df = spark.createDataFrame([("1", "101"), ("2", "010")], "key string, diffmask string")
    legend = ["a", "b", "c"]
    assert rows(extract_at(df, 1, legend)) == [("2",)]
    assert rows(extract_at(df, 2, legend)) == [("1",)]
    for outside in (-1, 3):
        with pytest.raises(IndexError):
            extract_at(df, outside, legend)


@pytest.mark.parametrize("mask", ["1", "101", None])
def test_a_mask_unlike_its_legend_is_refused(spark, mask):
    df = attach_legend(spark.createDataFrame([("1", mask)], "key string, diffmask string"), ["a", "b"])
    other = spark.createDataFrame([("2",)], "key string")
    with pytest.raises(Exception, match="legend"):
        merge({"m": df, "c": other}).collect()


@pytest.mark.parametrize("left,right,wide", [
    ("int", "float", "double"), ("short", "float", "float"), ("int", "double", "double"), ("float", "double", "double"),
    ("byte", "long", "bigint"), ("bigint", "float", None), ("bigint", "double", None), ("int", "string", None)])
def test_widening_is_lossless_or_refused(left, right, wide):
    from pyspark.sql import types as T
    from snapweave.plans.schema import widen
    a, b = (T._parse_datatype_string(f"x {t}").fields[0].dataType for t in (left, right))
    for pair in ((a, b), (b, a)):
        if wide is None:
            with pytest.raises(SchemaConflict):
                widen(*pair)
        else:
            assert widen(*pair).simpleString() == wide


def test_merge_keeps_large_integers_apart(spark):
    ints = spark.createDataFrame([(16777216,), (16777217,)], "k int")
    assert merge({"a": ints, "b": spark.createDataFrame([(1.5,)], "k float")}).count() == 3
    with pytest.raises(SchemaConflict):
        merge({"a": ints.selectExpr("cast(k as bigint) k"), "b": spark.createDataFrame([(1.5,)], "k double")})


def test_nested_records_evolve_by_field(spark):
    a = spark.createDataFrame([((1,),)], "r struct<a:int>")
    b = spark.createDataFrame([((1, "x"),), (None,)], "r struct<a:bigint,b:string>")
    got = merge({"a": a, "b": b})
    assert got.schema["r"].dataType.simpleString() == "struct<a:bigint,b:string>"
    assert sorted((str(r["r"]), r["diffmask"]) for r in got.collect()) == [
        ("None", "01"), ("Row(a=1, b='x')", "01"), ("Row(a=1, b=None)", "10")]


def test_reader_schema_defaults_and_named_types(spark, tmp_path):
    from snapweave import diff, read_snapshot
    from snapweave.sources.schemas import load_schema
    (tmp_path / "s.avsc").write_text("""{"type": "record", "name": "t", "fields": [
        {"name": "id", "type": "int"}, {"name": "v", "type": "int", "default": 7},
        {"name": "p", "type": {"type": "record", "name": "point", "fields": [{"name": "x", "type": "int"},
            {"name": "y", "type": "int", "default": 2}]}},
        {"name": "q", "type": ["null", "point"], "default": null}]}""")
    schema = load_schema(str(tmp_path / "s.avsc"))
    assert schema["q"].dataType == schema["p"].dataType
    spark.sql("select 1 id, named_struct('x', 1) p").write.parquet(f"{tmp_path}/a")
    spark.sql("select 1 id, 7 v, named_struct('x', 1, 'y', 2) p").write.parquet(f"{tmp_path}/b")
    a, b = (read_snapshot(spark, f"{tmp_path}/{n}", schema=schema) for n in "ab")
    assert [r["type"] for r in diff(a, b).collect()] == ["kernel"]


def test_diff_of_records_with_a_type_column(spark, tmp_path):
    from snapweave import diff, diff_summary, write_diff
    a = spark.createDataFrame([("x", 1)], "type string, v int")
    with pytest.raises(ValueError, match="output="):
        diff(a, a)
    out = diff(a, a, output="class")
    assert rows(diff_summary(out, "class")) == [("kernel", 1)]
    assert write_diff(out, f"{tmp_path}/d", output="class") == {"kernel": 1, "add": 0, "del": 0}


def test_timestamps_are_grouped_by_instant(spark):
    from snapweave import mutation_pairs
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:  # 02:30 happens twice when summer time ends
        df = attach_legend(spark.sql("""select timestamp_seconds(1414283400 + 3600 * i) t, i v, if(i = 0, '10', '01') diffmask
                                        from range(2) as r(i)"""), ["a", "b"])
        assert mutation_pairs(df, "t").collect() == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_counts_are_bigint(spark):
    from snapweave import mutation_stats
    df = attach_legend(spark.createDataFrame([("1", 1, "10"), ("1", 2, "01")], "k string, v int, diffmask string"), ["a", "b"])
    assert dict(mutation_stats(df, "k").dtypes)["count"] == "bigint"


def test_checkpoint_folder_is_required_off_local_mode():
    from types import SimpleNamespace
    from snapweave.session import ensure_checkpoint_dir, is_local
    assert is_local("local[8]") and is_local("local") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(master="yarn", getConf=lambda: conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))


def test_staged_tables_are_dropped(spark):
    import os
    from snapweave.sources.stage import drop_staged, stage_path, stage_table
    drop_staged(spark)
    stage_table(spark.range(3), "gone")
    folder = os.path.dirname(stage_path(spark).removeprefix("file:"))
    assert [n for n in os.listdir(folder) if n.startswith("gone")]
    assert drop_staged(spark) == 1
    assert not [n for n in os.listdir(folder) if n.startswith("gone")]


def test_nearest_label_with_list_and_nulls(spark):
    from snapweave import nearest_label
    df = spark.createDataFrame([("ASIA",), ("EURO",), (None,)], "name string")
    got = {r["name"]: (r["nearest_label"], r["distance"])
           for r in nearest_label(df, "name", ["AFRICA", "ASIA", "EUROPE"]).collect()}
    assert got == {"ASIA": ("ASIA", 0), "EURO": ("EUROPE", 2), None: (None, None)}


def test_nearest_label_function_on_nulls(spark):
    from snapweave.functions import nearest_label as nearest
    got = spark.createDataFrame([(None,), ("ASIA",)], "name string").select(
        "name", nearest(F.col("name"), ["AFRICA", "ASIA"]).alias("n")).collect()
    assert {r["name"]: r["n"] for r in got} == {None: None, "ASIA": "ASIA"}


def test_to_date_null_mask(spark):
    df = spark.createDataFrame([(None, "n"), ("01", "x")], "diffmask string, v string")
    out = {r["v"]: (r["dm_from_datetime"], r["dm_to_datetime"])
           for r in to_date(df, snapshots=["a", "b"], times=[10, 20]).collect()}
    assert out == {"n": (None, None), "x": (10, 20)}


def test_empty_inputs_give_empty_results(spark):
    from snapweave import diff_summary, mutation_stats
    e = spark.createDataFrame([], KV)
    assert diff(e, e).count() == 0 and diff(e, e, mode="count").count() == 0
    assert diff_summary(diff(e, e)).count() == 0
    labels = ["/x/importdatetime=2014-01-10T00_00_00p00_00", "/x/importdatetime=2014-01-11T00_00_00p00_00"]
    m = merge({labels[0]: e, labels[1]: e})
    assert m.count() == 0 and legend_of(m) == labels
    assert extract(m, labels[0]).count() == 0 and to_date(m).count() == 0
    assert mutation_stats(m, "key").count() == 0
    assert mutation_stats(m, "key", hot_key_rows=1, num_ranges=3).count() == 0
    assert all(compact(e, 3, c).count() == 0 for c in ("range", "none"))


def test_column_names_with_dots_and_spaces(spark):
    from snapweave import mutation_stats, nearest_label
    a = spark.createDataFrame([("1", 1), ("2", 2)], "`my.key` string, `a value` int")
    b = spark.createDataFrame([("1", 1), ("2", 3)], "`my.key` string, `a value` int")
    assert sorted(r["type"] for r in diff(a, b).collect()) == ["add", "del", "kernel"]
    labels = ["/x/importdatetime=2014-01-10T00_00_00p00_00", "/x/importdatetime=2014-01-11T00_00_00p00_00"]
    m = merge({labels[0]: a, labels[1]: b})
    assert rows(m) == [("1", 1, "11"), ("2", 2, "10"), ("2", 3, "01")]
    assert extract(m, labels[1]).count() == 2 and to_date(m).count() == 3
    assert compact(a, 2).count() == 2 and compact(a, 2, "range").count() == 2
    for hot in (10**9, 1):
        got = [(tuple(r["fields"]), r["count"]) for r in mutation_stats(m, "my.key", hot_key_rows=hot).collect()]
        assert got == [(("a value",), 1)]
    assert nearest_label(a, "my.key", ["1", "2"]).where("distance = 0").count() == 2


def test_non_ascii_labels_and_values(spark, tmp_path):
    from snapweave import mutation_stats, nearest_label
    a = spark.createDataFrame([("ключ", "été"), ("鍵", "値")], "k string, v string")
    b = spark.createDataFrame([("ключ", "зима"), ("鍵", "値")], "k string, v string")
    labels = ["/données/été", "/données/hiver"]
    out = str(tmp_path / "m")
    merge({labels[0]: a, labels[1]: b}).write.parquet(out)
    back = spark.read.parquet(out)
    assert legend_of(back) == sorted(labels)
    assert rows(extract(back, "/données/hiver")) == [("ключ", "зима"), ("鍵", "値")]
    assert [(tuple(r["fields"]), r["count"]) for r in mutation_stats(back, "k").collect()] == [(("v",), 1)]
    got = {r["v"]: r["nearest_label"] for r in nearest_label(a, "v", ["ete", "été", "値"]).collect()}
    assert got == {"été": "été", "値": "値"}
