"""Digest diffs, statistics kept up to date, the import catalogue, and the layouts of compact."""

import random

import pytest
from pyspark.sql import functions as F

from snapweave import (append_snapshot, bucket_digests, compact, diff, diff_by_digest, import_catalogue, imports_between, last_imports, merge,
                       mutation_stats, read_imports, render_log, stage_table, update_mutation_stats, write_output)
from snapweave.operators.digest import changed_buckets
from tests.conftest import rows
from tests.inspect_plan import exchanges, physical_plan


def _random(spark, seed, n=60, extra=()):
    r = random.Random(seed)
    pick = lambda: (r.choice([None, 0, 1, 2]), r.choice([None, "a", "b"]), r.choice([None, 1.5, float("nan")]))
    return spark.createDataFrame([pick() for _ in range(n)] + list(extra), "bucket int, `a.b` string, x double")


@pytest.mark.parametrize("mode", ["set", "count"])
@pytest.mark.parametrize("seed", [1])
def test_digest_diff_equals_diff(spark, mode, seed):
    # few values: copies, nulls, NaN and records on both sides; some buckets agree, some do not
    a, b = _random(spark, seed, 12), _random(spark, seed + 10, 12)
    for left, right in ((a, b), (a, a), (a, b.limit(0))):
        want = str(rows(diff(left, right, mode=mode)))      # as text: NaN is no equal of itself
        assert str(rows(diff_by_digest(left, right, mode=mode, buckets=7))) == want
        assert str(rows(diff_by_digest(left, right, mode=mode, by=["bucket"], buckets=1000))) == want


def test_nulls_and_nesting_tell_records_apart(spark):
    pairs = [("a int, b int", [(None, 1)], [(1, None)]),
             ("a array<int>", [([None, 1],)], [([1, None],)]),
             ("a array<array<int>>", [([[1], [2]],)], [([[1, 2]],)]),
             ("a array<array<int>>", [([[], [1]],)], [([[1], []],)]),
             ("a struct<x:int,y:int>", [((None, 1),)], [((1, None),)]),
             ("a struct<x:int>", [(None,)], [((None,),)]),
             ("a map<string,int>", [({"k": None},)], [({},)]),
             ("a string, b string", [("ab", "c")], [("a", "bc")])]
    for schema, left, right in pairs:
        a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
        assert changed_buckets(bucket_digests(a, buckets=1), bucket_digests(b, buckets=1)).count() == 1, schema
        assert changed_buckets(bucket_digests(a, buckets=1), bucket_digests(a, buckets=1)).count() == 0, schema


def test_only_changed_ranges_are_shuffled(spark, tmp_path):
    orders = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") / 100).cast("int").alias("day"), F.lit("old").alias("v"))
    paths = [str(tmp_path / x) for x in ("a", "b")]
    write_output(orders, paths[0])
    write_output(orders.withColumn("v", F.when(F.col("day") == 7, F.lit("new")).otherwise(F.col("v"))), paths[1])
    a, b = [spark.read.parquet(p) for p in paths]
    stored = [stage_table(bucket_digests(x, by="day")) for x in (a, b)]
    assert changed_buckets(*stored).count() == 1
    out = diff_by_digest(a, b, *stored, by="day")
    assert rows(out) == rows(diff(a, b))
    # the stored digests are used, so the one exchange of records is that of the changed day
    plan = physical_plan(out).splitlines()
    assert len([line for line in plan if "Exchange hashpartitioning(k#" in line]) == 1
    assert not any("shiftrightunsigned" in line for line in plan)
    # digests of other columns are not used, and do no harm
    assert rows(diff_by_digest(a, b, *stored, columns=["day", "v"], by="day")) == rows(diff(a, b, columns=["day", "v"]))


@pytest.mark.parametrize("order", ["reference", "chronological"])
def test_statistics_after_each_import_equal_the_full_run(spark, tmp_path, order):
    r = random.Random(5)
    path, state, stats = str(tmp_path / "log"), {}, None
    for i in range(3):
        for _ in range(25 if not i else 5):
            state[r.randrange(30)] = (r.choice("xyz"), r.choice([None, 1, 2]))
        for _ in range(3):
            state.pop(r.randrange(30), None)
        data = [(k if k else None, *v) for k, v in state.items()] + [(5, "x", 9)]
        append_snapshot(path, f"/d/{i:02d}", spark.createDataFrame(data, "k int, a string, b int"))
        full = mutation_stats(render_log(spark, path), "k", order)
        if i:
            stats = update_mutation_stats(spark, path, stats, "k", order)
            assert rows(stats) == rows(full)
        stats = stage_table(full if not i else stats)
    append_snapshot(path, "/d/99", spark.createDataFrame([(1, "x", 1, 7)], "k int, a string, b int, c int"))    # another schema
    assert rows(update_mutation_stats(spark, path, stats, "k", order)) == rows(mutation_stats(render_log(spark, path), "k", order))
    append_snapshot(path, "/d/00a", spark.createDataFrame([(1, "x", 1, 7)], "k int, a string, b int, c int"))
    with pytest.raises(ValueError, match="not the last"):
        update_mutation_stats(spark, path, stats, "k", order)


def test_catalogue_lists_imports_and_picks_by_number_and_time(spark, tmp_path):
    root = tmp_path / "orders"
    days = [f"importdatetime=2014-01-{d}T01_16_16p01_00" for d in ("20", "18", "19")]
    for n, day in enumerate(days):
        write_output(spark.range(n + 1).withColumn("day", F.lit(day[-17:])), str(root / day))
    (root / "notes.txt").write_text("not an import")
    (root / "importdatetime=2014-01-21T01_16_16p01_00").mkdir()
    catalogue = import_catalogue(spark, str(root))
    found = {r["label"].rsplit("/", 1)[1]: r for r in catalogue.collect()}
    assert sorted(found) == sorted(days)
    for day in days:
        parts = list((root / day).glob("*.parquet"))
        assert (found[day]["files"], found[day]["bytes"]) == (len(parts), sum(p.stat().st_size for p in parts))
    assert found[days[1]]["time_ms"] == 1390004176000
    names = lambda picked: [label.rsplit("/", 1)[1] for label in read_imports(picked)]
    assert names(last_imports(catalogue, 2)) == [days[2], days[0]]
    assert names(last_imports(catalogue, 0)) == []
    assert names(imports_between(catalogue, "2014-01-18 00:16:16 UTC", "2014-01-19 00:16:16 UTC")) == [days[1], days[2]]
    merged = merge(read_imports(last_imports(catalogue, 2)))
    assert days[1] not in "".join(merged.inputFiles()) and days[2] in "".join(merged.inputFiles())
    empty = tmp_path / "none"
    empty.mkdir()
    assert import_catalogue(spark, str(empty)).count() == 0


def _boxes(spark, path):
    """Per file the least and greatest value of both columns."""
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("a"), F.max("a"), F.min("b"), F.max("b"))
    return [tuple(r)[1:] for r in files.collect()]


def test_curve_layout_lets_filters_on_each_column_skip_files(spark, tmp_path):
    df = stage_table(spark.range(20000).select((F.xxhash64("id") % 1000).alias("a"), F.exp((F.hash("id") % 100) / 10).alias("b")))
    paths = {c: str(tmp_path / c) for c in ("range", "curve")}
    write_output(compact(df, 16, "range"), paths["range"])
    write_output(compact(df, 16, "curve", by=["a", "b"]), paths["curve"])
    assert rows(spark.read.parquet(paths["curve"])) == rows(df)
    cut = df.agg(F.percentile_approx("b", 0.9)).first()[0]
    hit = {c: sum(lo <= cut <= hi for _, _, lo, hi in _boxes(spark, p)) for c, p in paths.items()}
    assert hit["range"] == 16 and hit["curve"] <= 8
    assert sum(lo <= 0 <= hi for lo, hi, _, _ in _boxes(spark, paths["curve"])) <= 8


def test_curve_takes_nulls_texts_dates_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None, None), ("b", 1, "2020-01-01"), ("", 2, None), ("é" * 9, None, "1900-01-01")],
                               "s string, n int, d string").withColumn("d", F.col("d").cast("date"))
    assert rows(compact(df, 3, "curve", by=["s", "n", "d"])) == rows(df)
    assert compact(df.limit(0), 3, "curve", by=["s"]).count() == 0
    with pytest.raises(ValueError, match="by"):
        compact(df, 3, "curve")
    with pytest.raises(TypeError, match="curve"):
        compact(df.withColumn("z", F.array("n")), 3, "curve", by=["z"])


def test_sorted_parts_need_no_exchange(spark, tmp_path):
    path = str(tmp_path / "in")
    write_output(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(6), path)
    out = compact(spark.read.parquet(path), 2, "sorted")
    assert exchanges(out) == 0
    parts = [[r["v"] for r in p] for p in out.rdd.glom().collect()]
    assert len(parts) <= 2 and all(p == sorted(p) for p in parts) and sorted(sum(parts, [])) == list(range(1000))
