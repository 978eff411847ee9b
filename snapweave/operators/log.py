"""A history that grows without being rewritten: presence changes, appended.

Each import added to a log writes only the records whose presence changed, with the
import's position: a record that appears, or is gone.  A record's presence is a row
of runs, so two facts follow.  It is in the last import if it changed an odd number
of times; and its mask is the exclusive or, over its changes, of the positions from
that one on.  Both are fixed-width aggregates with map-side partial sums, so adding
an import and rendering the masks cost one exchange each, and no stored file is touched.

The legend is a folder of its own with one small file per import.  An import is
part of the log once its legend row is written, after its changes; a broken attempt
leaves a folder of changes that no legend row names, which is not read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.mask import MASK_COLUMN, MaskLayout, render_mask, with_legend
from ..plans.schema import conform_columns, named, reconcile
from ..sources.snapshots import write_output

# The folders and helper columns of a log.
LEGEND, CHANGES = "legend", "changes"
AT, NOW = "__at", "__now"


def log_legend(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(label, folder of its changes) in the order the imports were added."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{LEGEND}")
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return []
    rows = spark.read.parquet(f"{path}/{LEGEND}").orderBy("position").collect()
    if [r["position"] for r in rows] != list(range(len(rows))):
        raise ValueError(f"the legend of {path} has a position twice or not at all: two imports were added at once")
    return [(r["label"], r["folder"]) for r in rows]


def _changes(spark: SparkSession, path: str, legend) -> DataFrame:
    """All changes of a log with their position, in the union of the schemas they were written with."""
    parts = [(at, spark.read.parquet(f"{path}/{CHANGES}/{folder}")) for at, (_, folder) in enumerate(legend)]
    target = reconcile([df.schema for _, df in parts])
    return reduce(lambda a, b: a.unionByName(b), [df.select(*conform_columns(df, target), F.lit(at).alias(AT)) for at, df in parts])


def append_snapshot(path: str, label: str, snapshot: DataFrame) -> int:
    """Add one import to the log at ``path``; returns how many records changed.

    A repeated label raises, as do data columns with the names used here.
    """
    spark = snapshot.sparkSession
    legend = log_legend(spark, path)
    if label in [name for name, _ in legend]:
        raise ValueError(f"import {label!r} is in the log already")
    taken = {AT, NOW, MASK_COLUMN} & set(snapshot.columns)
    if taken:
        raise ValueError(f"the records have columns {sorted(taken)}; rename them, those names are used here")
    # NOW tells whether the new import has the record, AT counts its earlier changes
    target = snapshot.schema
    if legend:
        before = _changes(spark, path, legend)
        target = reconcile([before.drop(AT).schema, snapshot.schema])
    new = snapshot.select(*conform_columns(snapshot, target), F.lit(1).alias(NOW), F.lit(0).alias(AT))
    rows = new if not legend else new.unionByName(before.select(*conform_columns(before, target), F.lit(0).alias(NOW), F.lit(1).alias(AT)))
    keys = [named(n) for n in target.fieldNames()]
    changed = (rows.groupBy(*keys).agg(F.max(NOW).alias(NOW), (F.sum(AT) % 2).alias(AT))
               .where(F.col(NOW) != F.col(AT)).select(*keys))
    folder = uuid.uuid4().hex
    write_output(changed, f"{path}/{CHANGES}/{folder}")
    entry = spark.createDataFrame([(len(legend), label, folder)], "position int, label string, folder string")
    write_output(entry.coalesce(1), f"{path}/{LEGEND}", mode="append")
    return spark.read.parquet(f"{path}/{CHANGES}/{folder}").count()


def _from_position_on(layout: MaskLayout, position: int) -> list[int]:
    """Words with the bits of ``position`` and all later ones set."""
    first, bit = layout.locate(position)
    return [0 if k < first else (1 << (bit + 1)) - 1 if k == first else (1 << layout.width(k)) - 1 for k in range(layout.num_words)]


def render_log(spark: SparkSession, path: str, imports: int | None = None, where=None) -> DataFrame:
    """The masked table of a log: each record once with its mask, the legend sorted as ``merge`` sorts it.

    ``imports`` takes the log as it was after so many imports.  ``where``, a function
    of a DataFrame, picks records before they are grouped.
    """
    legend = log_legend(spark, path)[:imports]
    if not legend:
        raise ValueError(f"no import has been added to {path}")
    labels = [label for label, _ in legend]
    layout = MaskLayout.of(labels)
    changes = _changes(spark, path, legend)
    if where is not None:
        changes = where(changes)
    keys = [named(c) for c in changes.columns if c != AT]
    words = layout.word_names(taken=changes.columns)
    tables = list(zip(*[_from_position_on(layout, p) for p in range(len(labels))], strict=True))
    toggles = [F.bit_xor(F.get(F.array(*[F.lit(v).cast("bigint") for v in table]), F.col(AT))).alias(w) for w, table in zip(words, tables, strict=True)]
    merged = changes.groupBy(*keys).agg(*toggles)
    mask = render_mask([F.col(w) for w in words], layout)
    order = sorted(range(len(labels)), key=labels.__getitem__)
    if order != list(range(len(labels))):
        mask = F.concat(*[F.substring(mask, i + 1, 1) for i in order])
    return merged.select(*keys, with_legend(mask, sorted(labels)))
