"""Validity intervals from presence masks.

For each record: ``dm_from_datetime`` is the time of the snapshot *before* its
first appearance (a lower bound of when it came to exist; the first snapshot
uses its own time) and ``dm_to_datetime`` the time of its last appearance,
both epoch milliseconds.  Gaps (``101``) collapse to one interval.  A record
present nowhere (all-zero mask) gets nulls, as does a null mask; a mask that is not
as long as the legend raises.

A projection only: the per-snapshot times are a literal array built on the
driver from the legend, so the plan has no exchange and no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import snapshot_times
from ..functions.mask import MASK_COLUMN, first_set, fits_legend, last_set, resolve_legend

# Output column names.
FROM_COLUMN = "dm_from_datetime"
TO_COLUMN = "dm_to_datetime"


def to_date(masked: DataFrame, snapshots=None, times=None) -> DataFrame:
    """Append ``dm_from_datetime`` / ``dm_to_datetime`` to a masked table.

    ``times`` (epoch ms, one per legend label) overrides parsing the
    ``importdatetime=`` component of the labels.
    """
    labels = resolve_legend(masked, snapshots)
    if times is None:
        times = snapshot_times(masked.sparkSession, labels)
    times = [int(t) for t in times]
    if len(times) != len(labels):
        raise ValueError(f"{len(times)} times for {len(labels)} snapshots")
    table = F.array(*[F.lit(t).cast("bigint") for t in times])
    mask = F.col(MASK_COLUMN)
    first, last = first_set(mask), last_set(mask)
    present = fits_legend(mask, len(labels)) & (first > 0)
    start = F.when(present, F.try_element_at(table, F.greatest(first - 1, F.lit(1))))
    end = F.when(present, F.try_element_at(table, last))
    return masked.select("*", start.alias(FROM_COLUMN), end.alias(TO_COLUMN))


def intervals(masked: DataFrame, snapshots=None, times=None, as_timestamp: bool = False) -> DataFrame:
    """:func:`to_date` with the interval optionally typed as timestamps."""
    out = to_date(masked, snapshots, times)
    if as_timestamp:
        out = (out.withColumn(FROM_COLUMN, F.timestamp_millis(FROM_COLUMN))
               .withColumn(TO_COLUMN, F.timestamp_millis(TO_COLUMN)))
    return out
