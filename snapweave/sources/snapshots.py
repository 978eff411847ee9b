"""Reading snapshots and writing results.

A snapshot is one full import of a table: a directory of part files.  Each
root is read on its own, so the snapshot a record came from is known exactly
(no guessing from file paths).

The part files of one import may have been written with different schemas.  Their
footers are read (not their data) and files of one schema are read together; each
group is conformed on its own, so that a column which only some files hold is kept,
and a default fills only the rows of files that lack the column.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.mask import MASK_COLUMN, attach_legend, legend_of
from ..plans.schema import conform, reconcile

DEFAULT_FORMAT = "parquet"


# Formats whose files carry their own schema; Spark infers one over all files of the others.
SELF_DESCRIBED = ("parquet", "orc", "avro")
FOOTER_THREADS = 16


def schema_groups(spark: SparkSession, files: list[str], fmt: str = DEFAULT_FORMAT) -> list[list[str]]:
    """``files`` grouped by the schema in their footer, in the order of their first file."""
    def footer(path: str) -> str:
        if fmt == "parquet":
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            meta = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(spark._jsc.hadoopConfiguration(), hadoop)
            return meta.getFileMetaData().getSchema().toString()
        return spark.read.format(fmt).load(path).schema.json()

    files = sorted(files)
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        footers = list(pool.map(footer, files))
    groups: dict[str, list[str]] = {}
    for path, schema in zip(files, footers, strict=True):
        groups.setdefault(schema, []).append(path)
    return list(groups.values())


def read_snapshot(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT,
                  schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Read one snapshot directory.

    ``schema`` is a reader schema (projection; a field that a file lacks reads as its
    default, else as a typed null).  Without it the rows have the fields of all
    files, reconciled as :func:`snapweave.merge` does it.  An empty
    directory raises Spark's ``UNABLE_TO_INFER_SCHEMA``.  ``fmt="avro"`` needs
    the spark-avro module on the classpath.
    """
    reader = spark.read.format(fmt).options(**options)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    whole = reader.load(path)
    groups = schema_groups(spark, whole.inputFiles(), fmt) if fmt in SELF_DESCRIBED else []
    if len(groups) < 2:
        # Read with the file's own schema, then conform: columns the reader schema
        # does not name are pruned at the scan, missing ones become typed nulls.
        return whole if schema is None else conform(whole, schema)
    parts = [spark.read.format(fmt).options(**{"basePath": path, **options}).load(files) for files in groups]
    target = schema or reconcile([part.schema for part in parts])
    united = reduce(lambda a, b: a.unionByName(b), [conform(part, target) for part in parts])
    legends = {tuple(legend_of(part) or ()) for part in parts if MASK_COLUMN in part.columns}
    if MASK_COLUMN in united.columns and len(legends) == 1 and (labels := legends.pop()):
        return attach_legend(united, labels)
    return united


def read_snapshots(spark: SparkSession, paths, fmt: str = DEFAULT_FORMAT, **options) -> dict[str, DataFrame]:
    """Read several roots, keyed by path (the snapshot label)."""
    return {path: read_snapshot(spark, path, fmt, **options) for path in paths}


def write_output(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, *, partition_by=None,
                 compression: str | None = "snappy", num_files: int | None = None,
                 mode: str = "errorifexists", **options) -> None:
    """Write a result.

    Refuses an existing output by default (``mode="errorifexists"``).
    ``num_files`` sets the file count through a round-robin repartition; when
    it is None, the partitioning produced by the plan (AQE-coalesced) is kept.
    """
    if num_files is not None:
        df = df.repartition(num_files)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if compression is not None:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.save(path)
