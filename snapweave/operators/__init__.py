"""Snapshot history operators: DataFrame in, DataFrame out."""

from .compact import compact
from .diff import diff, diff_summary, write_diff
from .digest import bucket_digests, diff_by_digest
from .extract import extract, extract_at
from .history import intervals, to_date
from .log import append_snapshot, render_log
from .long_merge import merge_labelled
from .match import nearest_label
from .merge import merge
from .mutation import mutation_pairs, mutation_stats
from .mutation_log import update_mutation_stats
from .store import extract_stored, read_store, write_store

__all__ = [
    "compact", "diff", "diff_summary", "write_diff", "extract", "extract_at", "intervals",
    "to_date", "nearest_label", "merge", "mutation_pairs", "mutation_stats",
    "append_snapshot", "render_log", "write_store", "read_store", "extract_stored",
    "merge_labelled", "bucket_digests", "diff_by_digest", "update_mutation_stats",
]
