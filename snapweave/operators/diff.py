"""Diff of two snapshots: which records were added, deleted or kept.

Plan: both inputs are tagged with a side bit (origin 1, destination 2),
unioned, and grouped on the whole record with ``bit_or`` (and ``count`` for the
count rule).  That is one hash exchange with map-side partial aggregation, so
any number of identical copies collapses before the shuffle; a full outer
join would need two exchanges and cannot pre-aggregate.

Classes: ``kernel`` (in both), ``add`` (destination only), ``del`` (origin
only).  The destination schema governs: origin columns are read as the
destination's types, columns the origin lacks read as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.schema import conform_columns, named
from ..sources.snapshots import write_output

# The diff classes.
KERNEL = "kernel"
ADD = "add"
DEL = "del"
TYPE_COLUMN = "type"

_SIDE = "__side"
_SIDES = "__sides"
_COUNT = "__copies"
ORIGIN_BIT = 1
DEST_BIT = 2


def _target(dest: DataFrame, columns) -> T.StructType:
    if columns is None:
        return dest.schema
    fields = {f.name: f for f in dest.schema.fields}
    missing = [c for c in columns if c not in fields]
    if missing:
        raise KeyError(f"destination has no columns {missing}")
    return T.StructType([fields[c] for c in columns])


def diff(orig: DataFrame, dest: DataFrame, columns=None, mode: str = "set", output: str = TYPE_COLUMN) -> DataFrame:
    """Classify the distinct records of two snapshots.

    ``mode="set"`` (default) classifies by presence and never loses a record.
    ``mode="count"`` applies the occurrence-count rule: a record seen twice in
    total is ``kernel`` (even if both copies are on one side), once is that
    side's class, three times or more is dropped.  Both agree when neither
    input holds duplicate records.  ``output`` names the class column; choose
    another where the records have a column of that name.
    """
    if mode not in ("set", "count"):
        raise ValueError(f"mode must be 'set' or 'count', not {mode!r}")
    target = _target(dest, columns)
    names = target.fieldNames()
    taken = {output, _SIDE, _SIDES, _COUNT} & set(names)
    if taken:
        raise ValueError(f"the records have columns {sorted(taken)}; pass output= or rename them")
    tagged = (orig.select(*conform_columns(orig, target), F.lit(ORIGIN_BIT).alias(_SIDE))
              .unionByName(dest.select(*conform_columns(dest, target), F.lit(DEST_BIT).alias(_SIDE))))
    keys = [named(n) for n in names]
    grouped = tagged.groupBy(*keys)
    if mode == "set":
        sides = F.col(_SIDES)
        out = grouped.agg(F.bit_or(_SIDE).alias(_SIDES))
        kind = (F.when(sides == ORIGIN_BIT | DEST_BIT, F.lit(KERNEL))
                .when(sides == DEST_BIT, F.lit(ADD))
                .otherwise(F.lit(DEL)))
        return out.select(*keys, kind.alias(output))
    out = grouped.agg(F.count(F.lit(1)).alias(_COUNT), F.bit_or(_SIDE).alias(_SIDES))
    kind = (F.when(F.col(_COUNT) == 2, F.lit(KERNEL))
            .when(F.col(_SIDES) == DEST_BIT, F.lit(ADD))
            .otherwise(F.lit(DEL)))
    return out.where(F.col(_COUNT) <= 2).select(*keys, kind.alias(output))


def diff_summary(diffed: DataFrame, output: str = TYPE_COLUMN) -> DataFrame:
    """Record count per class (the per-output counters of a diff run)."""
    return diffed.groupBy(named(output)).agg(F.count(F.lit(1)).alias("records"))


def _class_counts(output: str) -> list[Column]:
    t = named(output)
    return [F.count_if(t == KERNEL).alias(KERNEL), F.count_if(t == ADD).alias(ADD),
            F.count_if(t == DEL).alias(DEL)]


def write_diff(diffed: DataFrame, path: str, fmt: str = "parquet", output: str = TYPE_COLUMN,
               **write_options) -> dict[str, int]:
    """Write ``type=add|del|kernel`` partitions (or of the ``output`` column) and return the class counts.

    The counts are gathered by an ``Observation`` during the same write, so the
    result is not scanned twice.
    """
    obs = Observation("diff_counts")
    write_output(diffed.observe(obs, *_class_counts(output)), path, fmt, partition_by=output,
                 **write_options)
    return {k: int(v) for k, v in obs.get.items()}
