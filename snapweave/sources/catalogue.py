"""The imports under a root: one row per import folder, from one listing.

A root such as ``/bi/orders`` holds a folder per import (``importdatetime=…``).  The
catalogue names them with their time, size and files, so that a job can take the last
few, or those between two times, and read no other folder.  The listing is Spark's
own (parallel over folders); no file is opened.

Defined results: files outside a folder with an import time, and empty folders, are
not listed; folders below an import folder belong to it; names that start with ``_``
or ``.`` are skipped, as Spark skips them; imports of one time are ordered by label.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import TIME_KEY, snapshot_time_ms
from .snapshots import DEFAULT_FORMAT, read_snapshots

LABEL, TIME, BYTES, FILES = "label", "time_ms", "bytes", "files"


def import_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """``label, time_ms, bytes, files`` of every import under ``root``; the label is the folder's path."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    folder = F.regexp_extract("path", r"^(.*?/" + re.escape(TIME_KEY) + r"=[^/]+)/", 1)
    files = listing.select(folder.alias(LABEL), "length").where(F.col(LABEL) != "")
    return (files.groupBy(LABEL).agg(F.sum("length").alias(BYTES), F.count(F.lit(1)).alias(FILES))
            .select(LABEL, snapshot_time_ms(F.col(LABEL)).alias(TIME), BYTES, FILES))


def last_imports(catalogue: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest imports of a catalogue."""
    if n < 0:
        raise ValueError("n must not be negative")
    return catalogue.where(F.col(TIME).isNotNull()).orderBy(F.desc(TIME), F.desc(LABEL)).limit(n)


def imports_between(catalogue: DataFrame, first: str | Column, last: str | Column) -> DataFrame:
    """The imports from ``first`` to ``last``, both included (timestamps, or texts Spark reads as such)."""
    as_ms = lambda t: F.unix_millis(t if isinstance(t, Column) else F.lit(t).cast("timestamp"))
    return catalogue.where(F.col(TIME).between(as_ms(first), as_ms(last)))


def read_imports(picked: DataFrame, fmt: str = DEFAULT_FORMAT, **options) -> dict[str, DataFrame]:
    """The picked imports, earliest first, as ``{label: rows}`` for merge, diff and to_date.

    Labels are what a legend holds: a name per import, on the driver.
    """
    labels = [r[LABEL] for r in picked.select(LABEL, TIME).orderBy(TIME, LABEL).collect()]
    return read_snapshots(picked.sparkSession, labels, fmt, **options)
