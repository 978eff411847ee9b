"""Physical-plan checks used by tests and the bench.

They read the plan Spark chose (``explain``) and count operators, so tests
can assert properties such as "extract plans with zero exchanges" or "the
diff is one hash aggregate, never a sort aggregate".
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The physical plan text (the initial plan when AQE wraps it)."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(df: DataFrame, name: str) -> int:
    """Number of plan lines whose operator starts with ``name`` (e.g. ``Exchange``)."""
    pattern = re.compile(r"^[\s:+\-*()\d]*" + re.escape(name) + r"\b")
    return sum(1 for line in physical_plan(df).splitlines() if pattern.match(line))


def exchanges(df: DataFrame) -> int:
    """Shuffle exchanges, excluding broadcasts and reused exchanges."""
    return count_nodes(df, "Exchange")


def summary(df: DataFrame) -> dict[str, int]:
    plan = physical_plan(df)
    return {
        "exchange": exchanges(df),
        "broadcast_exchange": count_nodes(df, "BroadcastExchange"),
        "hash_aggregate": count_nodes(df, "HashAggregate"),
        "sort_aggregate": count_nodes(df, "SortAggregate"),
        "object_hash_aggregate": count_nodes(df, "ObjectHashAggregate"),
        "window": count_nodes(df, "Window"),
        "python": plan.count("MapInArrow") + plan.count("MapInPandas") + plan.count("BatchEvalPython")
        + plan.count("ArrowEvalPython"),
    }
