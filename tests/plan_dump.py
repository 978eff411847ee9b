"""Write PLANS.md: the physical plan of every job on stored Parquet inputs.

``python -m tests.plan_dump [sf_dir] [out.md]``.  Snapshots and the merged
table are first written to a scratch folder, so each plan shows one operator
over plain scans (pushed filters, read schemas, exchanges).
"""

from __future__ import annotations

import re
import sys
import tempfile


def _clean(text: str) -> str:
    text = re.sub(r"#\d+L?", "", text)                 # expression ids
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"file:[^\],]*/", ".../", text)       # scratch paths
    return "\n".join(line.rstrip() for line in text.splitlines())


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    tree = qe.executedPlan().toString()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    formatted = qe.explainString(mode)
    scans = [line.strip() for line in formatted.splitlines()
             if line.startswith(("PushedFilters", "ReadSchema"))]
    return _clean(tree) + "\n\nscans:\n" + _clean("\n".join(scans))


def main(argv):
    sys.path.insert(0, ".")
    from pyspark.sql import functions as F

    from snapweave import compact, diff, extract, merge, mutation_stats, to_date
    from snapweave.sources import derived, read_snapshot, write_output
    from snapweave.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out_md = argv[2] if len(argv) > 2 else "PLANS.md"
    spark = local_session(cpus=8, shuffle_partitions=8)
    root = tempfile.mkdtemp(prefix="snapweave-plans-")
    paths = []
    for i, frame in enumerate(derived.order_snapshots(spark, sf_dir).values()):
        path = f"{root}/orders/importdatetime=2014-01-{18 + i}T01_16_16p01_00"
        write_output(frame, path)
        paths.append(path)
    snaps = [read_snapshot(spark, p) for p in paths]
    write_output(merge(dict(zip(paths, snaps))), f"{root}/merged")
    merged = read_snapshot(spark, f"{root}/merged")
    hot = merged.withColumn("grp", F.when(F.col("o_orderkey") % 2 == 0, F.lit(-1))
                            .otherwise(F.col("o_orderkey")))
    cases = [
        ("diff of two stored snapshots, key filter pushed",
         diff(snaps[0], snaps[1]).where("o_orderkey < 1000")),
        ("merge of three stored snapshots", merge(dict(zip(paths, snaps)))),
        ("incremental merge: stored history + one snapshot", merge({"h": merged, paths[2] + "-next": snaps[2]})),
        ("extract, last snapshot, two columns", extract(merged, paths[2]).select("o_orderkey", "o_totalprice")),
        ("extract, middle snapshot", extract(merged, paths[1])),
        ("to_date", to_date(merged)),
        ("compact", compact(snaps[0])),
        ("mutation_stats, ordinary keys (per-key window)", mutation_stats(merged, "o_orderkey")),
        ("mutation_stats, half the rows in one key (range split)",
         mutation_stats(hot, "grp", hot_key_rows=500)),
    ]
    with open(out_md, "w") as fh:
        fh.write("# Physical plans\n\nGenerated by `python -m tests.plan_dump` "
                 f"(inputs derived from `{sf_dir}`, written to Parquet first; "
                 "`local[8]`, 8 shuffle partitions, AQE on, initial plans).\n")
        for title, df in cases:
            fh.write(f"\n## {title}\n\n```\n{_plan(df)}\n```\n")
    print("wrote", out_md)


if __name__ == "__main__":
    main(sys.argv)
