"""Compaction: rewrite a snapshot as fewer parts, keeping every row.

Four layouts:

* ``cluster="none"`` (default): input partitions are packed together without a
  shuffle.  A pack never splits a partition, so it gives at most as many parts
  as the scan has.
* ``cluster="sorted"``: packed in the same way, then each part is sorted.  No
  exchange either; equal and similar records lie together, which compresses better
  and gives row groups narrow statistics inside each part.
* ``cluster="curve"``: parts follow a space-filling curve over the columns ``by``,
  so each part holds a small box of them and a filter on any of them skips parts.
  A column's values are replaced by their place among its quantiles (one pass of
  mergeable sketches), so skew and units do not matter; the bits of the places are
  interleaved.  Costs that pass, a sampling pass and a shuffle.
* ``cluster="range"``: a global sort; parts cover disjoint record ranges, which
  gives tight min/max statistics for later scans.  Costs one sampling pass and
  a shuffle; a per-row tie-breaker lets the range partitioner cut through long
  runs of identical records.

The number of parts follows from a target file size unless it is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.schema import has_map, named

_ROW = "__row"
_CURVE = "__curve"
CURVE_BITS = 8            # bits of each column's place: 255 quantiles
TARGET_FILE_BYTES = 128 << 20
# Spark's size of a plan without statistics is the largest long.
UNKNOWN_BYTES = (1 << 63) - 1


def orderable(name: str, dtype: T.DataType) -> Column:
    """A sortable and hashable stand-in for a column (maps become sorted entry arrays)."""
    col = named(name)
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(col))
    return col


def plan_bytes(df: DataFrame) -> int:
    """Spark's size of the plan: the files' bytes of a scan, ``UNKNOWN_BYTES`` or more where it knows none."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def file_count(df: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Parts of about ``target_bytes``, from the plan's size (a scan's is its files' bytes).

    Where Spark knows no size, the number of partitions stays.
    """
    size = plan_bytes(df)
    if size >= UNKNOWN_BYTES:
        return max(1, df.rdd.getNumPartitions())
    return max(1, -(-size // target_bytes))


def _places(df: DataFrame, by: list[str], bits: int) -> list[Column]:
    """Each column as its place among its quantiles, from 0 (nulls) to ``2**bits - 1``."""
    cuts = (1 << bits) - 2
    numbers = {}
    for name in by:
        dtype = df.schema[name].dataType
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = F.unix_micros(named(name).cast("timestamp"))
        elif isinstance(dtype, T.NumericType):
            col = named(name)
        elif isinstance(dtype, T.StringType):
            # the first bytes as a number keep the order of the texts
            col = F.conv(F.rpad(F.hex(F.substring(F.encode(named(name), "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
        else:
            raise TypeError(f"column {name!r} of type {dtype.simpleString()} cannot be laid along a curve")
        numbers[name] = col
    shares = [F.lit((i + 1) / (cuts + 1)) for i in range(cuts)]
    found = df.agg(*[F.percentile_approx(c, F.array(*shares)).alias(f"q{i}") for i, c in enumerate(numbers.values())]).first()
    places = []
    for i, col in enumerate(numbers.values()):
        steps = sorted(set(found[f"q{i}"] or ()))
        listed = F.array(*[F.lit(x) for x in steps]) if steps else None
        place = F.lit(1) if listed is None else F.size(F.filter(listed, lambda x: x <= col)) + 1  # noqa: B023
        places.append(F.when(col.isNull(), 0).otherwise(place))
    return places


def curve(df: DataFrame, by: list[str], bits: int = CURVE_BITS) -> Column:
    """The place of a row on the curve over ``by``: interleaved bits, highest first, as a BIGINT."""
    if not 1 <= len(by) * bits <= 63:
        raise ValueError("by must name a column, and at most 63 bits in all")
    z = F.lit(0).cast("bigint")
    for i, place in enumerate(_places(df, by, bits)):
        wide = place.cast("bigint")
        for b in range(bits):
            bit = F.shiftright(wide, b).bitwiseAND(F.lit(1).cast("bigint"))
            z = z + F.shiftleft(bit, b * len(by) + len(by) - 1 - i)
    return z


def compact(df: DataFrame, num_files: int | None = None, cluster: str = "none",
            target_bytes: int = TARGET_FILE_BYTES, by: list[str] | None = None) -> DataFrame:
    """``df`` laid out as at most ``num_files`` partitions (write it to get that many files)."""
    if cluster not in ("none", "sorted", "curve", "range"):
        raise ValueError(f"cluster must be 'none', 'sorted', 'curve' or 'range', not {cluster!r}")
    if (cluster == "curve") != bool(by):
        raise ValueError("cluster='curve' needs the columns 'by', the other layouts take none")
    if num_files is None:
        num_files = file_count(df, target_bytes)
    if num_files < 1:
        raise ValueError("num_files must be positive")
    if cluster == "none":
        return df.coalesce(num_files)
    keys = [orderable(f.name, f.dataType) for f in df.schema.fields]
    if cluster == "sorted":
        return df.coalesce(num_files).sortWithinPartitions(*keys)
    taken = {_ROW, _CURVE} & set(df.columns)
    if taken:
        raise ValueError(f"the records have columns {sorted(taken)}; rename them, those names are used here")
    if cluster == "curve":
        # the record's hash cuts through rows of one place, by content, so a repeated task routes every row as before
        placed = df.withColumn(_CURVE, curve(df, by)).withColumn(_ROW, F.xxhash64(*[
            named(f.name) for f in df.schema.fields if not has_map(f.dataType)] or [F.lit(0)]))
        return placed.repartitionByRange(num_files, _CURVE, _ROW).sortWithinPartitions(_CURVE, *keys).drop(_CURVE, _ROW)
    # The hash breaks ties by content, so a repeated task routes every row as
    # before; copies of one record are told apart by their place in the input.
    placed = df.sortWithinPartitions(*keys).withColumn(_ROW, F.monotonically_increasing_id())
    return placed.repartitionByRange(num_files, *keys, F.col(_ROW)).sortWithinPartitions(*keys).drop(_ROW)
