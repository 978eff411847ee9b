"""Files that tasks write and read in the shared folder, through Arrow's file systems."""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from ..sources.stage import stage_path


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh, empty folder under the shared folder, as a URI every task can open; ``drop_staged`` deletes it."""
    folder = stage_path(spark, f"llm-{kind}")
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    return folder


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def committed(folder: str, name: str):
    """An output stream whose file appears under ``name`` only when the block ends well.

    Attempts write under names of their own; the last to end replaces an equal file.
    """
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    context = TaskContext.get()
    mine = f"{path}/.{name}.{context.taskAttemptId() if context else 0}"
    with fs.open_output_stream(mine, compression=None) as out:
        yield out
    fs.move(mine, f"{path}/{name}")


def partition_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0
