"""Merge: N snapshots stored once, each record with a presence mask.

Inputs are raw snapshots (no ``diffmask``; the record is present in that
snapshot) and/or masked tables from earlier merges (their masks are re-laid
onto the new legend).  The legend is the sorted, de-duplicated set of all
labels.  Equal records collapse to one row whose mask is the OR of its
presence bits, so merging is a set operation: duplicates inside a snapshot
leave one row.

Plan: the schemas are reconciled on the driver (no data read), every input is
projected onto the target schema plus ``ceil(n/63)`` BIGINT mask words, the
projections are unioned, and one hash aggregate on the record ORs the words
with ``bit_or`` (partial aggregation before the single exchange).  The mask is
rendered to text once per output row and the legend attached as metadata.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.mask import (MASK_COLUMN, MaskLayout, legend_of, one_hot_words, realign_words,
                              render_mask, with_legend)
from ..plans.schema import conform_columns, named, reconcile


def _inputs(snapshots) -> list[tuple[str, DataFrame]]:
    items = list(snapshots.items()) if isinstance(snapshots, dict) else list(snapshots)
    if not items:
        raise ValueError("merge needs at least one input")
    return [(str(label), df) for label, df in items]


def input_legends(snapshots, legends=None) -> list[tuple[str, DataFrame, list[str] | None]]:
    """(label, frame, inner legend or None for a raw snapshot) per input."""
    legends = legends or {}
    planned = []
    for label, df in _inputs(snapshots):
        if MASK_COLUMN in df.columns:
            inner = legends.get(label) or legend_of(df)
            if not inner:
                raise ValueError(f"masked input {label!r} has no legend; pass legends={{{label!r}: [...]}}")
            planned.append((label, df, list(inner)))
        else:
            planned.append((label, df, None))
    return planned


def merge(snapshots, legends=None) -> DataFrame:
    """Merge snapshots into one masked table.

    ``snapshots``: mapping (or list of pairs) label -> DataFrame.  For masked
    inputs the label is not used; their own legend is (from the ``diffdirs``
    metadata, or ``legends[label]`` for formats that drop metadata).
    """
    planned = input_legends(snapshots, legends)
    labels = sorted({lab for label, _, inner in planned for lab in (inner or [label])})
    layout = MaskLayout.of(labels)
    target = reconcile([df.schema for _, df, _ in planned], exclude={MASK_COLUMN})
    names = target.fieldNames()
    words = layout.word_names(taken=names)

    branches = []
    for label, df, inner in planned:
        if inner is None:
            bits = one_hot_words(layout, layout.index(label))
        else:
            bits = realign_words(F.col(MASK_COLUMN), inner, layout)
        branches.append(df.select(*conform_columns(df, target),
                                  *[b.alias(w) for b, w in zip(bits, words)]))
    union = reduce(lambda a, b: a.unionByName(b), branches)
    keys = [named(n) for n in names]
    merged = union.groupBy(*keys).agg(*[F.coalesce(F.bit_or(w), F.lit(0)).alias(w) for w in words])
    mask = render_mask([F.col(w) for w in words], layout)
    return merged.select(*keys, with_legend(mask, labels))
