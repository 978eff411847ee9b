"""Snapshot sources and sinks."""

from .catalogue import import_catalogue, imports_between, last_imports, read_imports
from .snapshots import read_snapshot, read_snapshots, write_output
from .stage import drop_staged, stage_table

__all__ = ["read_snapshot", "read_snapshots", "write_output", "stage_table", "drop_staged",
           "import_catalogue", "imports_between", "last_imports", "read_imports"]
