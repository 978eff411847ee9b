"""Sources, sinks and the streaming reuse of the row-wise operators."""

from __future__ import annotations

import os

import pytest

from snapweave import extract, legend_of, merge, read_snapshot, to_date, write_diff, write_output
from snapweave.operators import diff
from snapweave.sources import derived
from tests.conftest import SF_SMALL, rows


def test_write_refuses_existing_output(spark, tmp_path):
    df = spark.createDataFrame([("1", 1)], "key string, value int")
    out = str(tmp_path / "out")
    write_output(df, out)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_output(df, out)


def test_write_num_files_and_compression(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id as string) AS key", "cast(id as int) AS value")
    out = str(tmp_path / "out")
    write_output(df, out, num_files=3, compression="zstd")
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 3 and all(".zstd." in f for f in parts)
    assert rows(read_snapshot(spark, out)) == rows(df)


def test_write_diff_partitions_and_counts(spark, tmp_path):
    s = derived.order_snapshots(spark, SF_SMALL)
    a, b = list(s.values())[:2]
    out = str(tmp_path / "diff")
    counts = write_diff(diff(a, b), out)
    assert sorted(d for d in os.listdir(out) if d.startswith("type=")) == ["type=add", "type=del", "type=kernel"]
    back = spark.read.parquet(out)
    assert {r["type"]: r["count"] for r in back.groupBy("type").count().collect()} == counts


def test_reader_schema_projects_and_fills(spark, tmp_path):
    df = spark.createDataFrame([("1", 1)], "key string, value int")
    out = str(tmp_path / "snap")
    write_output(df, out)
    got = read_snapshot(spark, out, schema="key string, value bigint, extra string")
    assert got.dtypes == [("key", "string"), ("value", "bigint"), ("extra", "string")]
    assert rows(got) == [("1", 1, None)]


def test_merge_from_written_snapshots(spark, tmp_path):
    paths = []
    for i, frame in enumerate(derived.order_snapshots(spark, SF_SMALL).values()):
        p = str(tmp_path / f"importdatetime=2014-01-1{i}T00_00_00p00_00")
        write_output(frame, p)
        paths.append(p)
    merged = merge({p: read_snapshot(spark, p) for p in paths})
    assert legend_of(merged) == sorted(paths)
    out = to_date(merged)
    assert out.where("dm_to_datetime IS NULL").count() == 0


def test_row_wise_operators_accept_streams(spark, tmp_path):
    masked_path = str(tmp_path / "merged")
    merge(derived.order_snapshots(spark, SF_SMALL)).write.parquet(masked_path)
    static = spark.read.parquet(masked_path)
    stream = spark.readStream.schema(static.schema).parquet(masked_path)
    # Streaming reads carry no column metadata from files: pass the legend.
    labels = list(derived.ORDER_LABELS)
    picked = extract(to_date(stream, snapshots=labels), labels[1], snapshots=labels)
    q = (picked.writeStream.format("memory").queryName("extract_stream").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("extract_stream")
    assert got.count() == extract(static, labels[1]).count()
    assert got.where("dm_to_datetime IS NULL").count() == 0


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_formats_without_metadata_take_an_explicit_legend(spark, tmp_path, fmt):
    from snapweave.cli import run
    merged = merge(derived.order_snapshots(spark, SF_SMALL))
    out = str(tmp_path / "m")
    write_output(merged, out, fmt, compression=None)
    back = read_snapshot(spark, out, fmt)
    assert legend_of(back) is None
    labels = list(derived.ORDER_LABELS)
    with pytest.raises(ValueError, match="legend"):
        extract(back, labels[0])
    assert extract(back, labels[0], snapshots=labels).count() == extract(merged, labels[0]).count()
    # The command line takes the same legend through --snapshots.
    run(spark, ["--format", fmt, "--compression", "none", "--snapshots", ",".join(labels),
                "todate", out, str(tmp_path / "dated")])
    dated = read_snapshot(spark, str(tmp_path / "dated"), fmt)
    assert dated.where("dm_to_datetime IS NULL").count() == 0


def test_avro_round_trip_when_module_present(spark, tmp_path):
    probe = str(tmp_path / "probe")
    try:
        spark.range(1).write.format("avro").save(probe)
    except Exception as exc:  # noqa: BLE001
        if "avro" in str(exc).lower():
            pytest.skip("spark-avro module not on the classpath")
        raise
    merged = merge(derived.order_snapshots(spark, SF_SMALL))
    out = str(tmp_path / "m")
    write_output(merged, out, "avro", compression="snappy")
    back = read_snapshot(spark, out, "avro")
    labels = list(derived.ORDER_LABELS)
    assert extract(back, labels[0], snapshots=labels).count() == extract(merged, labels[0]).count()


def test_read_snapshots_and_multi_column_partitioning(spark, tmp_path):
    from snapweave import read_snapshots
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, p string")
    out = str(tmp_path / "parts")
    write_output(df, out, partition_by=["p", "k"])
    assert sorted(os.listdir(out))[-2:] == ["p=x", "p=y"]
    snaps = read_snapshots(spark, [out])
    assert list(snaps) == [out]
    assert rows(snaps[out], "k", "v", "p") == rows(df, "k", "v", "p")


def test_merge_of_one_masked_input_is_identity(spark):
    from snapweave.functions.mask import attach_legend
    masked = attach_legend(spark.createDataFrame([("1", 1, "101"), ("2", 2, "010")],
                                                 "key string, value int, diffmask string"), ["a", "b", "c"])
    out = merge({"m": masked})
    assert legend_of(out) == ["a", "b", "c"]
    assert rows(out) == rows(masked)
