"""Snapshot labels: nearest-label lookup and import times written in paths.

Labels are snapshot names (usually the directory a full import was written
to).  Times are read from a ``importdatetime=`` path component such as
``/data/t/importdatetime=2014-01-18T01_16_16p01_00/part``, where ``_`` stands
for ``:`` and ``p`` for ``+`` in the UTC offset.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the path-time format.
TIME_KEY = "importdatetime"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
TIME_ESCAPES_FROM = "_p"
TIME_ESCAPES_TO = ":+"

# The candidates travel as one literal with every task; a larger list than this
# many characters is refused (about a million labels of usual length).
MAX_CANDIDATE_CHARS = 1 << 24


def path_value(path: Column, key: str) -> Column:
    """Value of the ``key=value`` component of a path ('' when absent)."""
    return F.regexp_extract(path, r"(?:^|/)" + re.escape(key) + r"=([^/]+)", 1)


def snapshot_time_ms(path: Column) -> Column:
    """Epoch milliseconds of the ``importdatetime=`` component of a path, else null."""
    raw = path_value(path, TIME_KEY)
    text = F.translate(raw, TIME_ESCAPES_FROM, TIME_ESCAPES_TO)
    return F.unix_millis(F.try_to_timestamp(text, F.lit(TIME_FORMAT)))


_TIMES_SEEN: dict[tuple[str, ...], list[int]] = {}


def snapshot_times(spark: SparkSession, labels) -> list[int]:
    """Times of a legend, one per label, evaluated with :func:`snapshot_time_ms`.

    The legend is driver metadata (one label per snapshot); it is evaluated as a
    single-row projection of literals so the parse rule has one definition, and
    remembered per legend.  Raises when a label has no readable time, because a
    skipped label would shift every later time against the mask positions.
    """
    labels = tuple(labels)
    if not labels:
        return []
    if labels in _TIMES_SEEN:
        return list(_TIMES_SEEN[labels])
    row = spark.range(1).select(
        *[snapshot_time_ms(F.lit(label)).alias(f"t{i}") for i, label in enumerate(labels)]
    ).first()
    times = [row[f"t{i}"] for i in range(len(labels))]
    bad = [label for label, t in zip(labels, times) if t is None]
    if bad:
        raise ValueError(f"no readable {TIME_KEY}=... component in labels: {bad}")
    _TIMES_SEEN[labels] = times
    return list(times)


def _check_candidates(candidates) -> list[str]:
    candidates = [str(c) for c in candidates]
    if not candidates:
        raise ValueError("nearest-label lookup needs at least one candidate")
    size = sum(map(len, candidates))
    if size > MAX_CANDIDATE_CHARS:
        raise ValueError(f"candidates of {size} characters exceed {MAX_CANDIDATE_CHARS}")
    return candidates


def _literal(candidates: list[str]) -> Column:
    """One array literal, so the plan's size does not depend on the number of labels."""
    for mark in ("\x00", "\x01", "\x1f"):
        if not any(mark in c for c in candidates):
            return F.split(F.lit(mark.join(candidates)), mark, -1)
    return F.lit(candidates)


def nearest_scored(value: Column, candidates) -> Column:
    """``struct<d, i>``: the smallest Levenshtein distance and the first candidate that has it.

    Null input gives null.  One fold over one literal: no join and no shuffle.
    """
    none = F.struct(F.lit(2 ** 31 - 1).alias("d"), F.lit(-1).alias("i"), F.lit(0).alias("at"))

    def step(best, candidate):
        d = F.levenshtein(value, candidate)
        return F.struct(F.least(best["d"], d).alias("d"), F.when(d < best["d"], best["at"]).otherwise(best["i"]).alias("i"),
                        (best["at"] + 1).alias("at"))

    return F.when(value.isNotNull(), F.aggregate(_literal(_check_candidates(candidates)), none, step))


def nearest_index(value: Column, candidates) -> Column:
    """0-based index of the candidate with the smallest distance; ties go to the lowest index."""
    return nearest_scored(value, candidates)["i"]


def nearest_label(value: Column, candidates) -> Column:
    """The candidate string chosen by :func:`nearest_index`."""
    return F.get(_literal(_check_candidates(candidates)), nearest_index(value, candidates))


def resolve_label(spark: SparkSession, name: str, candidates, match: str = "exact") -> int:
    """Index of ``name`` among legend labels.

    ``exact`` requires the label to be present.  ``nearest`` picks the closest
    label by edit distance (lowest index on ties) and never fails.
    """
    candidates = list(candidates)
    if match == "exact":
        if name not in candidates:
            raise KeyError(f"label {name!r} is not in the legend {candidates}")
        return candidates.index(name)
    if match == "nearest":
        return spark.range(1).select(nearest_index(F.lit(name), candidates).alias("i")).first()["i"]
    raise ValueError(f"match must be 'exact' or 'nearest', not {match!r}")
