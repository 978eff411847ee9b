"""The command-line jobs, run in-process on the test session."""

from __future__ import annotations

import pytest

from snapweave import cli, legend_of
from snapweave.sources import derived, write_output
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def snapshot_dirs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("imports")
    paths = []
    for i, frame in enumerate(derived.order_snapshots(spark, SF_SMALL).values()):
        p = str(root / f"orders/importdatetime=2014-01-{18 + i}T01_16_16p01_00")
        write_output(frame, p)
        paths.append(p)
    return paths


def test_unknown_job_exits_255(capsys):
    assert cli.main(["nope"]) == 255
    assert cli.main(["--format", "orc", "nope"]) == 255
    assert cli.main([]) == 255
    assert "unknown job" in capsys.readouterr().err
    assert cli._job_name(["--format", "orc", "--compression=zstd", "todate", "a", "b"]) == "todate"
    assert cli.main(["--help"]) == 0
    assert "todate" in capsys.readouterr().out


def test_jobs_chain(spark, snapshot_dirs, tmp_path):
    out = tmp_path / "out"
    report = cli.run(spark, ["diff", snapshot_dirs[0], snapshot_dirs[1], str(out / "diff")])
    assert set(report["counts"]) == {"add", "del", "kernel"}

    cli.run(spark, ["merge", ",".join(snapshot_dirs), str(out / "merged")])
    merged = spark.read.parquet(str(out / "merged"))
    assert legend_of(merged) == sorted(snapshot_dirs)

    cli.run(spark, ["extract", str(out / "merged"), snapshot_dirs[2], str(out / "s2")])
    assert rows(spark.read.parquet(str(out / "s2"))) == rows(spark.read.parquet(snapshot_dirs[2]))

    cli.run(spark, ["todate", str(out / "merged"), str(out / "dated")])
    dated = spark.read.parquet(str(out / "dated"))
    assert dated.where("dm_from_datetime IS NULL").count() == 0

    cli.run(spark, ["mutation", str(out / "merged"), str(out / "mut"), "o_orderkey"])
    assert spark.read.parquet(str(out / "mut")).count() > 0
    cli.run(spark, ["mutation", str(out / "merged"), str(out / "mut_split"), "o_orderkey",
                    "--hot-key-rows", "1", "--num-ranges", "3"])
    assert rows(spark.read.parquet(str(out / "mut_split")).selectExpr(
        "array_join(fields, ',')", "diffmaskIn", "diffmaskOut", "count")) == rows(
        spark.read.parquet(str(out / "mut")).selectExpr(
            "array_join(fields, ',')", "diffmaskIn", "diffmaskOut", "count"))

    cli.run(spark, ["compact", snapshot_dirs[0], str(out / "compact"), "--num-files", "3"])
    assert rows(spark.read.parquet(str(out / "compact"))) == rows(spark.read.parquet(snapshot_dirs[0]))

    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        cli.run(spark, ["todate", str(out / "merged"), str(out / "dated")])


def test_incremental_merge_through_cli(spark, snapshot_dirs, tmp_path):
    first = str(tmp_path / "first")
    cli.run(spark, ["merge", ",".join(snapshot_dirs[:2]), first])
    cli.run(spark, ["merge", ",".join([first, snapshot_dirs[2]]), str(tmp_path / "all")])
    cli.run(spark, ["merge", ",".join(snapshot_dirs), str(tmp_path / "once")])
    incremental = spark.read.parquet(str(tmp_path / "all"))
    assert legend_of(incremental) == sorted(snapshot_dirs)
    assert rows(incremental) == rows(spark.read.parquet(str(tmp_path / "once")))


def test_submit_script_exit_code():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, os.path.join(root, "snapweave_submit.py"), "nope"],
                          capture_output=True, text=True, timeout=120, cwd=root)
    assert done.returncode == 255 and "unknown job" in done.stderr


def test_global_num_files(spark, snapshot_dirs, tmp_path):
    import os
    out = str(tmp_path / "merged3")
    cli.run(spark, ["--num-files", "3", "merge", ",".join(snapshot_dirs), out])
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 3


def test_diff_with_avro_reader_schema_file(spark, snapshot_dirs, tmp_path):
    import json
    from snapweave.sources.schemas import load_schema
    avsc = {"type": "record", "name": "Order", "namespace": "t", "fields": [
        {"name": "o_orderkey", "type": "long"},
        {"name": "o_orderstatus", "type": ["null", "string"], "default": None},
        {"name": "o_comment", "type": ["null", "string"], "default": None}]}
    path = tmp_path / "orders.avsc"
    path.write_text(json.dumps(avsc))
    schema = load_schema(str(path))
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields] == [
        ("o_orderkey", "bigint", False), ("o_orderstatus", "string", True), ("o_comment", "string", True)]
    out = str(tmp_path / "diff")
    report = cli.run(spark, ["diff", snapshot_dirs[0], snapshot_dirs[1], out, "--schema", str(path)])
    assert sum(report["counts"].values()) > 0
    back = spark.read.parquet(out)
    assert sorted(back.columns) == ["o_comment", "o_orderkey", "o_orderstatus", "type"]
    assert back.where("o_comment IS NOT NULL").count() == 0


def test_avro_schema_conversion_covers_nested_types():
    from snapweave.sources.schemas import avro_record
    node = {"type": "record", "name": "r", "fields": [
        {"name": "tags", "type": {"type": "array", "items": "string"}},
        {"name": "props", "type": {"type": "map", "values": ["null", "int"]}},
        {"name": "kind", "type": {"type": "enum", "name": "k", "symbols": ["A", "B"]}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "amount", "type": {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}},
        {"name": "inner", "type": {"type": "record", "name": "i", "fields": [{"name": "a", "type": "double"}]}}]}
    assert avro_record(node).simpleString() == (
        "struct<tags:array<string>,props:map<string,int>,kind:string,day:date,"
        "amount:decimal(10,2),inner:struct<a:double>>")
    with pytest.raises(ValueError):
        avro_record({"type": "record", "name": "x", "fields": [{"name": "u", "type": ["int", "string"]}]})


def test_explain_writes_nothing(spark, snapshot_dirs, tmp_path, capsys):
    import os
    out = str(tmp_path / "never")
    cli.run(spark, ["--explain", "merge", ",".join(snapshot_dirs), out])
    cli.run(spark, ["--explain", "diff", snapshot_dirs[0], snapshot_dirs[1], out])
    assert not os.path.exists(out)
    assert "HashAggregate" in capsys.readouterr().out


def test_compact_keeps_its_layout_under_global_num_files(spark, snapshot_dirs, tmp_path):
    import os
    out = str(tmp_path / "c")
    cli.run(spark, ["--num-files", "7", "compact", snapshot_dirs[0], out, "--num-files", "3", "--cluster", "range"])
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 3


def test_explain_before_the_job(spark, snapshot_dirs, tmp_path, capsys):
    from snapweave import cli
    out = str(tmp_path / "x")
    assert cli.main(["--explain", "diff", snapshot_dirs[0], snapshot_dirs[1], out]) == 0
    assert "Physical Plan" in capsys.readouterr().out and not (tmp_path / "x").exists()
