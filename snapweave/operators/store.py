"""A stored history laid out by mask, so that one import of many is cheap to get.

``write_store`` splits a masked table in two.  The mask dictionary has one row for
each distinct mask: its id, the mask and the part it belongs to.  The records are
stored by part (a folder each) with the id in place of the mask.  Masks in text
order are dealt to at most ``max_parts`` parts; while there are no more masks than
parts, each has its own.

``extract_stored`` turns a label into the ids of the masks that hold it.  Their
parts, at most ``max_parts`` numbers, become a partition filter, so other folders
are not listed or opened, whatever the label's place in the legend.  Where a part
holds several masks the ids decide row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import resolve_label
from ..functions.mask import LEGEND_KEY, MASK_COLUMN, ONE, checked_mask, legend_of, resolve_legend, with_legend
from ..plans.schema import has_map, named
from ..sources.snapshots import write_output
from ..sources.stage import stage_table

# The folders and helper columns of a store.
MASKS, RECORDS, SHAPE = "masks", "records", "shape"
MASK_ID, PART = "__mask_id", "__part"
MAX_PARTS = 1024
BROADCAST_MASK_BYTES = 64 << 20
MASK_BYTES = 48           # what a broadcast dictionary row takes beside its mask


def mask_dictionary(masked: DataFrame, size: int, max_parts: int = MAX_PARTS) -> DataFrame:
    """``__mask_id, diffmask, __part, records``: the distinct masks; ids and parts follow the text order."""
    counts = stage_table(masked.groupBy(checked_mask(F.col(MASK_COLUMN), size).alias(MASK_COLUMN))
                         .agg(F.count(F.lit(1)).alias("records")), "masks")
    kinds = counts.count()
    if kinds <= max_parts:
        numbered = counts.withColumn(PART, F.row_number().over(Window.orderBy(MASK_COLUMN)) - 1)  # at most max_parts rows
    else:
        numbered = counts.repartitionByRange(max_parts, MASK_COLUMN).withColumn(PART, F.spark_partition_id())
    numbered = stage_table(numbered, "mask-parts")
    place = F.row_number().over(Window.partitionBy(PART).orderBy(MASK_COLUMN)) - 1
    return stage_table(numbered.select((F.shiftleft(F.col(PART).cast("long"), 32) + place).alias(MASK_ID), MASK_COLUMN, PART, "records"),
                       "mask-dictionary")


def _small(masks: DataFrame) -> DataFrame:
    """The dictionary, broadcast while its counted bytes allow."""
    size = masks.agg(F.sum(F.octet_length(MASK_COLUMN) + MASK_BYTES)).first()[0] or 0
    return F.broadcast(masks) if size <= BROADCAST_MASK_BYTES else masks


def write_store(masked: DataFrame, path: str, snapshots=None, max_parts: int = MAX_PARTS, files_per_part: int = 1) -> None:
    """Write a masked table as a store under ``path``, which must not exist.

    A part's records go to about ``files_per_part`` files each; a range split over part, id
    and the records' hash keeps a mask that holds most records from landing in one task.
    """
    taken = {MASK_ID, PART} & set(masked.columns)
    if taken:
        raise ValueError(f"the records have columns {sorted(taken)}; rename them, those names are used here")
    if max_parts < 1 or files_per_part < 1:
        raise ValueError("max_parts and files_per_part must be positive")
    labels = resolve_legend(masked, snapshots)
    masks = mask_dictionary(masked, len(labels), max_parts)
    names = [c for c in masked.columns if c != MASK_COLUMN]
    coded = masked.join(_small(masks.select(MASK_ID, PART, MASK_COLUMN)), MASK_COLUMN).select(*[named(c) for c in names], MASK_ID, PART)
    parts = masks.select(PART).distinct().count()
    # maps have no hash; where every column is one, a record's place in its mask does not matter
    spread = F.xxhash64(*[named(f.name) for f in masked.schema.fields if f.name in names and not has_map(f.dataType)] or [F.lit(0)])
    placed = coded.repartitionByRange(max(1, parts * files_per_part), PART, MASK_ID, spread).sortWithinPartitions(PART, MASK_ID)
    write_output(masks.select(MASK_ID, with_legend(F.col(MASK_COLUMN), labels), PART, "records").coalesce(1), f"{path}/{MASKS}")
    # an empty file keeps the columns of a history without records
    write_output(coded.drop(PART).limit(0).coalesce(1), f"{path}/{SHAPE}")
    write_output(placed, f"{path}/{RECORDS}", partition_by=PART)


def stored_masks(spark: SparkSession, path: str) -> DataFrame:
    """The mask dictionary of a store, with the legend on its mask column."""
    return spark.read.parquet(f"{path}/{MASKS}")


def _records(spark: SparkSession, path: str) -> DataFrame:
    shape = spark.read.parquet(f"{path}/{SHAPE}").schema
    return spark.read.schema(T.StructType([*shape.fields, T.StructField(PART, T.IntegerType())])).parquet(f"{path}/{RECORDS}")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The whole masked table of a store, legend included."""
    masks = stored_masks(spark, path)
    records = _records(spark, path)
    names = [c for c in records.columns if c not in (MASK_ID, PART)]
    joined = records.join(_small(masks.select(MASK_ID, MASK_COLUMN)), MASK_ID)
    return joined.select(*[named(c) for c in names], with_legend(F.col(MASK_COLUMN), legend_of(masks)))


def extract_stored(spark: SparkSession, path: str, label: str, match: str = "exact") -> DataFrame:
    """The records of one import, reading only the parts whose masks hold it."""
    masks = stored_masks(spark, path)
    labels = legend_of(masks)
    position = resolve_label(spark, label, labels, match)
    held = masks.where(F.substring(MASK_COLUMN, position + 1, 1) == ONE)
    parts = [r[PART] for r in held.select(PART).distinct().orderBy(PART).collect()]     # at most max_parts
    records = _records(spark, path).where(F.col(PART).isin(parts))
    names = [c for c in records.columns if c not in (MASK_ID, PART)]
    mixed = masks.where(F.col(PART).isin(parts)).where(F.substring(MASK_COLUMN, position + 1, 1) != ONE)
    if not mixed.isEmpty():
        records = records.join(_small(held.select(MASK_ID, MASK_COLUMN)).drop(MASK_COLUMN), MASK_ID, "left_semi")
    return records.select(*[named(c) for c in names])
