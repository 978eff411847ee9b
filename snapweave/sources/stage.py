"""Staged tables: cut a long lineage by writing it to the shared checkpoint folder.

Jobs that read one input more than once (for instance a hot-key sample and
then the main pass) should not recompute an expensive upstream plan each time.
:func:`stage_table` writes the frame as Parquet under ``spark.checkpoint.dir``
(the folder every executor can reach) and returns a fresh scan of it, which
keeps column metadata such as the mask legend and allows column pruning.
Re-running after a lost executor reads the written files, not the lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

STAGE_FOLDER = "snapweave-stage"
_staged: list[str] = []


def stage_table(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` to a unique Parquet folder in the checkpoint dir and read it back."""
    path = stage_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_path(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder name in the checkpoint dir, which :func:`drop_staged` will delete."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{STAGE_FOLDER}/{name or 'table'}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables staged by this process, once nothing reads them any more."""
    dropped = 0
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        dropped += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return dropped
