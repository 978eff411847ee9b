"""Plan shape of every registered query, as a markdown table.

``python -m tests.plan_report [sf_dir]``: exchanges (shuffles), aggregate
kinds, windows and Python operators in the physical plan Spark picks.
Queries that stage a table or probe for hot keys run those small jobs first.
"""

from __future__ import annotations

import sys


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests import inspect_plan as inspect
    from snapweave.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cpus=8, shuffle_partitions=8)
    print("| query | shuffles | hash agg | sort agg | window | python | broadcast |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, build in entry.queries().items():
        s = inspect.summary(build(spark, sf_dir))
        print(f"| {name} | {s['exchange']} | {s['hash_aggregate']} | {s['sort_aggregate']} | "
              f"{s['window']} | {s['python']} | {s['broadcast_exchange']} |")


if __name__ == "__main__":
    main(sys.argv)
