"""snapweave: history of tables imported as repeated full snapshots, on Spark.

Compact, diff, merge (with presence masks), extract, validity intervals and
field-mutation statistics, each a DataFrame -> DataFrame function built from
Spark's own expressions, aggregates and exchanges.
"""

from .functions.mask import LEGEND_KEY, MASK_COLUMN, attach_legend, legend_of
from .operators import (append_snapshot, bucket_digests, compact, diff, diff_by_digest, diff_summary, extract, extract_at, extract_stored,
                        intervals, merge, merge_labelled, mutation_pairs, mutation_stats, nearest_label, read_store,
                        render_log, to_date, update_mutation_stats, write_diff, write_store)
from .sources import (drop_staged, import_catalogue, imports_between, last_imports, read_imports, read_snapshot,
                      read_snapshots, stage_table, write_output)

__version__ = "0.1.0"

__all__ = [
    "LEGEND_KEY", "MASK_COLUMN", "attach_legend", "legend_of", "compact",
    "diff", "diff_summary", "extract", "extract_at", "intervals", "merge", "mutation_pairs",
    "mutation_stats", "nearest_label", "to_date", "write_diff", "read_snapshot",
    "append_snapshot", "render_log", "write_store", "read_store", "extract_stored",
    "merge_labelled", "bucket_digests", "diff_by_digest", "update_mutation_stats",
    "import_catalogue", "imports_between", "last_imports", "read_imports",
    "read_snapshots", "stage_table", "drop_staged", "write_output",
]
