"""Mutation statistics kept up to date with a growing log.

An import that joins a log changes the presence of some records.  A key without
such a record has the versions it had: each of its masks grows by its own last
character, which keeps their order and their pairs.  So the new statistics are the
old ones with grown masks, less the old pairs of the touched keys, plus their new
pairs.  Only the history of touched keys is grouped and paired again; the rest of
the log is read and passed over by a semi join.

Defined results: equal to ``mutation_stats(render_log(spark, path), key)``.  The
import must have the greatest label of the log (masks grow at their end), else it
raises; where it changed the schema of the log, the full run is done, as an added
column may reorder versions of equal masks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.schema import named
from .log import AT, _changes, log_legend, render_log
from .mutation import COUNT, FIELDS, HOT_KEY_ROWS, MASK_IN, MASK_OUT, mutation_stats

_TOUCHED = "__touched"


def _grown(mask: str):
    return F.concat(F.col(mask), F.substring(mask, -1, 1)).alias(mask)


def update_mutation_stats(spark: SparkSession, path: str, stats: DataFrame, key: str, order: str = "reference",
                          hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The statistics of the log at ``path``, from ``stats`` of the log before its last import."""
    legend = log_legend(spark, path)
    if len(legend) < 2:
        raise ValueError("there is no import before the last one; use mutation_stats")
    labels = [label for label, _ in legend]
    if max(labels[:-1]) > labels[-1]:
        raise ValueError(f"import {labels[-1]!r} is not the last of the log by name; use mutation_stats")
    before, now = _changes(spark, path, legend[:-1]), _changes(spark, path, legend)
    if before.schema.simpleString() != now.schema.simpleString():
        return mutation_stats(render_log(spark, path), key, order, hot_key_rows)
    touched = (now.where(F.col(AT) == len(legend) - 1).select(named(key).alias(_TOUCHED))
               .where(F.col(_TOUCHED).isNotNull()).distinct())
    of_touched = lambda df: df.join(touched, named(key).eqNullSafe(F.col(_TOUCHED)), "left_semi")
    gone = mutation_stats(render_log(spark, path, len(legend) - 1, of_touched), key, order, hot_key_rows)
    come = mutation_stats(render_log(spark, path, len(legend), of_touched), key, order, hot_key_rows)
    grown = lambda df, sign: df.select(FIELDS, _grown(MASK_IN), _grown(MASK_OUT), (F.col(COUNT) * sign).alias(COUNT))
    parts = grown(stats, 1).unionByName(grown(gone, -1)).unionByName(come.select(FIELDS, MASK_IN, MASK_OUT, COUNT))
    return parts.groupBy(FIELDS, MASK_IN, MASK_OUT).agg(F.sum(COUNT).alias(COUNT)).where(F.col(COUNT) != 0)
