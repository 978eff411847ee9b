"""Command-line jobs, one sub-command per operator.

    spark-submit --py-files snapweave.zip snapweave_submit.py <job> [args]
    python -m snapweave.cli <job> [args]          (local session)

    compact  <input> <output> [--num-files N | --target-mb N] [--cluster none|sorted|curve|range] [--by COLUMNS]
    diff     <origin> <dest> <output> [--schema DDL|file.avsc|file.json] [--mode set|count]
    merge    <dir,dir,...> <output>
    extract  <masked input> <label> <output> [--match exact|nearest]
    todate   <masked input> <output>
    mutation <masked input> <output> <field> [--order reference|chronological] [--pairs]
             [--hot-key-rows N] [--num-ranges N]

Common options, given before the job: ``--format`` (read and write, default
parquet), ``--compression`` (default snappy), ``--num-files`` (files per
output; default: the plan's partitions after AQE), ``--snapshots``
(comma-joined legend for masked inputs whose format dropped the column
metadata; a legend stored with the data wins), ``--explain`` (print the
physical plan and write nothing).  Outputs must not exist yet.  An unknown job prints
the usage and exits with status 255.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators import (compact, diff, extract, merge, mutation_pairs, mutation_stats, to_date,
                        write_diff)
from .functions.mask import attach_legend, legend_of
from .sources import drop_staged, read_snapshot, write_output
from .sources.schemas import load_schema

# Global options that take no value.
FLAGS = ("--explain",)
JOBS = ("compact", "diff", "merge", "extract", "todate", "mutation")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="snapweave", description="Snapshot history jobs on Spark")
    p.add_argument("--format", default="parquet")
    p.add_argument("--compression", default="snappy")
    p.add_argument("--snapshots", default=None, help="comma-joined legend for masked inputs")
    p.add_argument("--num-files", type=int, default=None, dest="out_files",
                   help="files per output (default: as many as the plan's partitions)")
    p.add_argument("--explain", action="store_true",
                   help="print the formatted physical plan instead of running the job")
    sub = p.add_subparsers(dest="job", required=True)

    c = sub.add_parser("compact")
    c.add_argument("input")
    c.add_argument("output")
    c.add_argument("--num-files", type=int, default=None, help="parts (default: by --target-mb)")
    c.add_argument("--cluster", default="none", choices=["none", "sorted", "curve", "range"])
    c.add_argument("--by", type=lambda t: t.split(","), help="columns of the curve, comma-joined")
    c.add_argument("--target-mb", type=int, default=128, help="size of a part when --num-files is not given")

    d = sub.add_parser("diff")
    d.add_argument("origin")
    d.add_argument("dest")
    d.add_argument("output")
    d.add_argument("--schema", default=None,
                   help="reader schema for both inputs: DDL, or a .avsc / Spark .json file")
    d.add_argument("--mode", default="set", choices=["set", "count"])

    m = sub.add_parser("merge")
    m.add_argument("inputs", help="comma-separated snapshot or masked directories")
    m.add_argument("output")

    e = sub.add_parser("extract")
    e.add_argument("input")
    e.add_argument("label")
    e.add_argument("output")
    e.add_argument("--match", default="exact", choices=["exact", "nearest"])

    t = sub.add_parser("todate")
    t.add_argument("input")
    t.add_argument("output")

    u = sub.add_parser("mutation")
    u.add_argument("input")
    u.add_argument("output")
    u.add_argument("field")
    u.add_argument("--order", default="reference", choices=["reference", "chronological"])
    u.add_argument("--pairs", action="store_true", help="write the pairs, not the counts")
    u.add_argument("--hot-key-rows", type=int, default=None,
                   help="groups above this many rows are split over tasks")
    u.add_argument("--num-ranges", type=int, default=None, help="range count of the hot-key split")
    return p


def run(spark: SparkSession, argv: list[str]) -> dict:
    """Run one job; returns a small report (e.g. diff class counts)."""
    args = _parser().parse_args(argv)
    fmt, comp = args.format, args.compression
    legend = args.snapshots.split(",") if args.snapshots else None

    def read(path, schema=None):
        return read_snapshot(spark, path, fmt, schema=schema)

    def read_masked(path):
        # --snapshots only fills in for inputs whose format dropped the legend.
        df = read(path)
        if legend and "diffmask" in df.columns and not legend_of(df):
            df = attach_legend(df, legend)
        return df

    def write(df, path, relayout=True):
        if args.explain:
            df.explain("formatted")
            return
        write_output(df, path, fmt, compression=comp,
                     num_files=args.out_files if relayout else None)

    if args.job == "compact":
        # compact lays out its own files (its --num-files); keep that layout.
        write(compact(read(args.input), args.num_files, args.cluster, args.target_mb << 20, args.by), args.output, relayout=False)
        return {"job": "compact"}
    if args.job == "diff":
        schema = load_schema(args.schema) if args.schema else None
        dest = read(args.dest, schema)
        orig = read(args.origin, schema)
        diffed = diff(orig, dest, mode=args.mode)
        if args.explain:
            diffed.explain("formatted")
            return {"job": "diff"}
        counts = write_diff(diffed, args.output, fmt, compression=comp, num_files=args.out_files)
        return {"job": "diff", "counts": counts}
    if args.job == "merge":
        paths = [p for p in args.inputs.split(",") if p]
        write(merge({p: read_masked(p) for p in paths}), args.output)
        return {"job": "merge", "inputs": len(paths)}
    if args.job == "extract":
        write(extract(read_masked(args.input), args.label, match=args.match), args.output)
        return {"job": "extract"}
    if args.job == "todate":
        write(to_date(read_masked(args.input)), args.output)
        return {"job": "todate"}
    masked = read_masked(args.input)
    op = mutation_pairs if args.pairs else mutation_stats
    tuning = {"num_ranges": args.num_ranges}
    if args.hot_key_rows is not None:
        tuning["hot_key_rows"] = args.hot_key_rows
    write(op(masked, args.field, args.order, **tuning), args.output)
    return {"job": "mutation"}


def _job_name(argv: list[str]) -> str | None:
    """The first token that is not a global option or its value."""
    i = 0
    while i < len(argv) and argv[i].startswith("--"):
        i += 1 if "=" in argv[i] or argv[i] in FLAGS else 2
    return argv[i] if i < len(argv) else None


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] in ("-h", "--help"):
        sys.stdout.write(__doc__ or "")
        return 0
    job = _job_name(argv)
    if job not in JOBS:
        sys.stderr.write(f"unknown job {job!r}; jobs: {', '.join(JOBS)}\n")
        sys.stderr.write(__doc__ or "")
        return 255
    spark = SparkSession.builder.appName(f"snapweave-{job}").getOrCreate()
    try:
        report = run(spark, argv)
    finally:
        drop_staged(spark)
    print(json.dumps(report))
    return 0


if __name__ == "__main__":
    sys.exit(main())
