"""Extract: one snapshot back out of a masked table.

A narrow filter on the snapshot's mask character followed by dropping the
mask; no exchange.  On a merged table the result is the distinct records of
that snapshot.  For the first and the last snapshot of the legend the filter
reaches the Parquet scan as a prefix / suffix predicate.  A mask that is not as
long as the legend raises (in the row groups that are read); a null one is absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import resolve_label
from ..functions.mask import MASK_COLUMN, bit_is_set, fits_legend, resolve_legend


def _present(masked: DataFrame, position: int, size: int) -> DataFrame:
    mask = F.col(MASK_COLUMN)
    return masked.where(fits_legend(mask, size) & bit_is_set(mask, position, size)).drop(MASK_COLUMN)


def extract(masked: DataFrame, label: str, snapshots=None, match: str = "exact") -> DataFrame:
    """Rows present in snapshot ``label``, without the mask column.

    ``match="exact"`` raises on a label missing from the legend;
    ``match="nearest"`` takes the closest label by edit distance (lowest
    legend position on ties).
    """
    labels = resolve_legend(masked, snapshots)
    position = resolve_label(masked.sparkSession, label, labels, match)
    return _present(masked, position, len(labels))


def extract_at(masked: DataFrame, position: int, snapshots=None) -> DataFrame:
    """Rows present at a 0-based legend position; a position outside the legend raises."""
    size = len(resolve_legend(masked, snapshots))
    if not 0 <= position < size:
        raise IndexError(f"position {position} is outside the legend of {size} snapshots")
    return _present(masked, position, size)
