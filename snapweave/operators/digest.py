"""Diff that shuffles only what changed: digests of buckets first, records after.

An import is cut into buckets by a hash of chosen columns (of the whole record by
default), so equal records share a bucket on both sides.  The digest of a bucket is
the sum of 128-bit hashes of its distinct records, with their number.  Where both
imports have the same digest, the bucket's records are ``kernel`` and are read from
the destination without a shuffle; the other buckets go through :func:`diff`.

Digests take one pass with map-side partial sums, of which only hashes are shuffled,
never records.  Stored beside an import (they are a small table: one row a bucket),
they serve every later diff.  ``by`` should name columns in whose ranges changes
cluster (a day, a partition column): the fewer buckets a change touches, the less is
shuffled.  Two different buckets of one digest have a chance of about 2**-128.

Defined results: those of :func:`diff` in both modes.  A bucket with copies of a
record takes the shuffled way, since a record is listed once (and counted, in
``mode="count"``); nulls, NaN and signed zeros compare as they do in grouping.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.schema import conform, named
from .diff import KERNEL, TYPE_COLUMN, _target, diff

BUCKET, RECORDS, COPIES = "bucket", "records", "copies"
SUMS = ("sum0", "sum1", "sum2", "sum3")
SCHEMA_KEY = "digest_of"            # in the metadata of the bucket column
BUCKETS = 1 << 16
_IN = "__bucket"
_CHANGED = "__changed_bucket"


def _hashable(col: Column, dtype: T.DataType) -> list[Column]:
    """What to hash of a value: hashes skip nulls and do not see where a nested value ends."""
    if isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda x: F.struct(*_hashable(x, dtype.elementType)))
        return [col.isNull(), F.size(col), items]
    if isinstance(dtype, T.MapType):
        entry = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        return _hashable(F.array_sort(F.map_entries(col)), T.ArrayType(entry))
    if isinstance(dtype, T.StructType):
        return [col.isNull(), *[h for f in dtype.fields for h in _hashable(col.getField(f.name), f.dataType)]]
    return [col.isNull(), col]


def _record_hash(fields: list[T.StructField], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[h for f in fields for h in _hashable(named(f.name), f.dataType)])


def _layout(schema: T.StructType, by, buckets: int) -> str:
    fields = [[f.name, f.dataType.simpleString()] for f in schema.fields]
    return json.dumps({"fields": fields, "by": by, "buckets": buckets})


def _bucketed(df: DataFrame, by, buckets: int) -> DataFrame:
    fields = [f for f in df.schema.fields if by is None or f.name in by]
    return df.withColumn(_IN, F.pmod(_record_hash(fields, 2), F.lit(buckets)).cast("int"))


def bucket_digests(df: DataFrame, by=None, buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket that holds a record: ``bucket, records, copies, sum0..sum3``.

    ``records`` counts distinct records, ``copies`` the rows beyond them.  Write it
    with ``write_output`` and give it to :func:`diff_by_digest` later.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    by = None if by is None else sorted([by] if isinstance(by, str) else by)
    missing = sorted(set(by or ()) - set(df.columns))
    if missing:
        raise KeyError(f"the records have no columns {missing}")
    taken = {_IN, _CHANGED} & set(df.columns)
    if taken:
        raise ValueError(f"the records have columns {sorted(taken)}; rename them, those names are used here")
    fields = df.schema.fields
    hashed = _bucketed(df, by, buckets).select(F.col(_IN).alias(BUCKET), _record_hash(fields, 0).alias("h0"), _record_hash(fields, 1).alias("h1"))
    distinct = hashed.groupBy(BUCKET, "h0", "h1").agg(F.count(F.lit(1)).alias("rows"))
    # halves of 32 bits, so that no sum of fewer than 2**31 records can overflow
    halves = [F.shiftrightunsigned("h0", 32), F.col("h0").bitwiseAND(F.lit(0xFFFFFFFF)),
              F.shiftrightunsigned("h1", 32), F.col("h1").bitwiseAND(F.lit(0xFFFFFFFF))]
    out = distinct.groupBy(BUCKET).agg(F.count(F.lit(1)).alias(RECORDS), F.sum(F.col("rows") - 1).alias(COPIES),
                                       *[F.sum(h).alias(s) for s, h in zip(SUMS, halves, strict=True)])
    marked = F.col(BUCKET).alias(BUCKET, metadata={SCHEMA_KEY: _layout(df.schema, by, buckets)})
    return out.select(marked, RECORDS, COPIES, *SUMS)


def _digests_of(side: DataFrame, stored: DataFrame | None, by, buckets: int) -> DataFrame:
    """Stored digests if they were made of these columns and buckets, else fresh ones."""
    if stored is not None and stored.schema[BUCKET].metadata.get(SCHEMA_KEY) == _layout(side.schema, by, buckets):
        return stored
    return bucket_digests(side, by, buckets)


def changed_buckets(orig_digests: DataFrame, dest_digests: DataFrame, mode: str = "set") -> DataFrame:
    """``bucket`` of those whose records must be compared; it has at most as many rows as there are buckets."""
    a, b = orig_digests.alias("a"), dest_digests.alias("b")
    same = F.lit(True)
    for name in (RECORDS, *SUMS):
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    same = same & (F.col(f"b.{COPIES}") == 0)
    if mode == "count":
        same = same & (F.col(f"a.{COPIES}") == 0)
    joined = a.join(b, F.col(f"a.{BUCKET}") == F.col(f"b.{BUCKET}"), "full_outer")
    return joined.where(~F.coalesce(same, F.lit(False))).select(F.coalesce(f"a.{BUCKET}", f"b.{BUCKET}").alias(BUCKET))


def diff_by_digest(orig: DataFrame, dest: DataFrame, orig_digests: DataFrame | None = None,
                   dest_digests: DataFrame | None = None, columns=None, mode: str = "set",
                   output: str = TYPE_COLUMN, by=None, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``diff(orig, dest, columns, mode, output)``; records of equal buckets are not shuffled.

    Digests made of other columns, types, ``by`` or ``buckets`` are not used but made
    anew.  Both inputs are read more than once: give stored tables.
    """
    by = None if by is None else sorted([by] if isinstance(by, str) else by)
    target = _target(dest, columns)
    left, right = conform(orig, target), conform(dest, target)
    changed = changed_buckets(_digests_of(left, orig_digests, by, buckets), _digests_of(right, dest_digests, by, buckets),
                              mode).withColumnRenamed(BUCKET, _CHANGED)
    # one INT per bucket at most, so its size is bounded by ``buckets``
    if buckets <= BUCKETS << 4:
        changed = F.broadcast(changed)
    left, right = _bucketed(left, by, buckets), _bucketed(right, by, buckets)
    is_changed = F.col(_IN) == F.col(_CHANGED)
    touched = [side.join(changed, is_changed, "left_semi").drop(_IN) for side in (left, right)]
    compared = diff(*touched, mode=mode, output=output)
    kernel = right.join(changed, is_changed, "left_anti").select(*[named(n) for n in target.fieldNames()], F.lit(KERNEL).alias(output))
    return compared.unionByName(kernel)
