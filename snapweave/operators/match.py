"""Nearest-label lookup as a table operator.

Each value of a string column is matched to the candidate with the smallest
Levenshtein distance; ties go to the earliest candidate.  A short list of labels
is carried into the plan as one literal.  A candidate table stays a table:

* Its labels, sorted by length, numbers of characters and text, are cut into leaves
  of 64, leaves into nodes of 64, and so on.  A node knows the least and the greatest number of
  characters of each class that its labels have, and its earliest place.
* No label below a node can be nearer to a value than the characters the value has
  beyond the node's greatest numbers, or lacks of its least ones.
* Each distinct value first walks down to the most promising leaf and scores it,
  which gives a distance to beat.  Then it walks down again through every node
  and to every label whose bound, or on a tie whose earliest place, could still beat
  that, and scores those.  The answer is exact; what the bounds rule out is never scored.

Each step is one join on the node number.  Nodes are broadcast while their counted
number allows, and labels while their counted bytes do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import MAX_CANDIDATE_CHARS, nearest_scored, _literal
from ..plans.schema import named
from ..sources.stage import stage_table

CLASSES = 26
FAN_BITS = 6              # 64 labels a leaf, 64 children a node
RANGE_LABELS = 1 << 18    # labels that one task sorts, on average
BROADCAST_NODES = 1 << 16
BROADCAST_LABEL_BYTES = 64 << 20
LABEL_BYTES = 300         # what a broadcast label takes beside its text
_VALUE, _BEST, _SCORED = "__value", "__best", "__scored"


def profile(text: Column) -> Column:
    """Number of characters of each class (code point modulo ``CLASSES``), as an array."""
    def counts(codes):
        return F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda k: F.size(F.filter(codes, lambda x: x == k)))

    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c) % CLASSES)
    return F.transform(F.array(codes), counts)[0].alias("profile")


def _spread(names: tuple[str, ...]) -> list[Column]:
    """The entries of a stored profile as columns, under each of ``names``."""
    return [F.get("profile", k).alias(f"{name}{k}") for name in names for k in range(CLASSES)]


def _bound() -> Column:
    """Edits that any label of a node is at least away, from ``p``, ``lo`` and ``hi`` of each class."""
    over, under = F.lit(0), F.lit(0)
    for k in range(CLASSES):
        over = over + F.greatest(F.col(f"p{k}") - F.col(f"hi{k}"), F.lit(0))
        under = under + F.greatest(F.col(f"lo{k}") - F.col(f"p{k}"), F.lit(0))
    return F.greatest(over, under)


class LabelTree:
    """Candidate labels cut into leaves and nodes; every table of it is staged."""

    def __init__(self, candidates: DataFrame, label: str, order_by: str):
        labels = (candidates.select(named(label).cast("string").alias("label"), named(order_by).alias("order"))
                  .where(F.col("label").isNotNull()).groupBy("label").agg(F.min("order").alias("order")))
        labels = stage_table(labels.select("label", "order", profile(F.col("label"))), "labels")
        size, octets = labels.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("label") + LABEL_BYTES), F.lit(0))).first()
        ranges = max(1, -(-size // RANGE_LABELS))
        keys = [F.length("label"), F.col("profile"), F.col("label")]
        placed = stage_table(labels.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
                             .withColumn("at", F.monotonically_increasing_id()), "labels-placed")
        self.levels = self._levels(placed, size, ranges)
        self.labels = placed.select(F.shiftright("at", FAN_BITS).alias("parent"), "label", F.col("order").alias("first"), *_spread(("lo", "hi")))
        if octets <= BROADCAST_LABEL_BYTES:
            self.labels = F.broadcast(self.labels)

    @staticmethod
    def _shifts(size: int, ranges: int) -> list[int]:
        """Shifts that turn a label's number into its node at each level, leaves first."""
        if ranges > 1:
            # a number is the task's above bit 33 and the place within it below
            return [6, 12, 18, 24, *[s for s in (39, 45, 51, 57) if ranges > 1 << (s - 33 - FAN_BITS) << FAN_BITS]]
        nodes, shifts = -(-size >> FAN_BITS), [FAN_BITS]
        while nodes > 1 << FAN_BITS:
            nodes, shifts = -(-nodes >> FAN_BITS), [*shifts, shifts[-1] + FAN_BITS]
        return shifts

    @classmethod
    def _levels(cls, placed: DataFrame, size: int, ranges: int) -> list[DataFrame]:
        """Tables ``node, parent, first, lo, hi`` from the top down; the last is of the leaves."""
        out, shifts, done = [], cls._shifts(size, ranges), 0
        below = placed.select(F.col("at").alias("node"), F.col("order").alias("first"), *_spread(("lo", "hi")))
        for i, shift in enumerate(shifts):
            spans = [f(f"{end}{k}").alias(f"{end}{k}") for end, f in (("lo", F.min), ("hi", F.max)) for k in range(CLASSES)]
            below = below.groupBy(F.shiftright("node", shift - done).alias("node")).agg(F.min("first").alias("first"), *spans)
            up = F.shiftright("node", shifts[i + 1] - shift) if i + 1 < len(shifts) else F.lit(-1).cast("long")
            below, done = stage_table(below, "nodes"), shift
            level = below.withColumn("parent", up)
            out.append(F.broadcast(level) if level.count() <= BROADCAST_NODES else level)
        return out[::-1]

    def _children(self, walked: DataFrame, level: DataFrame, below: str = "node") -> DataFrame:
        """Rows of ``walked`` (``node`` and others) with each child of their node and its bound."""
        kept = [c for c in walked.columns if c != "node"]
        return (walked.withColumnRenamed("node", "parent").join(level, "parent")
                .select(*kept, "parent", below, "first", _bound().alias("bound")))

    def nearest(self, values: DataFrame) -> DataFrame:
        """``value, best, scored`` of each row of ``value`` (distinct, not null)."""
        ps = [f"p{k}" for k in range(CLASSES)]
        values = stage_table(values.select("value", F.monotonically_increasing_id().alias("vid"), profile(F.col("value"))), "values")
        known = values.select("vid", "value", *_spread(("p",)))
        best = F.struct(F.levenshtein("value", "label").alias("distance"), F.col("first").alias("order"), F.col("label"))

        walked = known.select("vid", *ps, F.lit(-1).cast("long").alias("node"))
        for level in self.levels:
            nearest = self._children(walked, level).groupBy("vid", *ps).agg(F.min(F.struct("bound", "first", "node")).alias("c"))
            walked = nearest.select("vid", *ps, F.col("c.node").alias("node"))
        at_leaf = walked.select("vid", "node").join(known, "vid")
        first = stage_table(self._children(at_leaf, self.labels, "label").groupBy("vid", "parent")
                            .agg(F.min(best).alias("best"), F.count("*").alias("scored")), "first-best")

        goal = known.join(first.select("vid", F.col("parent").alias("done"), F.col("best.distance").alias("goal"),
                                       F.col("best.order").alias("place")), "vid")
        # the order decides on a tie only, so an equal bound still counts where it may come earlier
        beats = (F.col("bound") < F.col("goal")) | ((F.col("bound") == F.col("goal")) & ~F.coalesce(F.col("first") > F.col("place"), F.lit(False)))
        walked = goal.withColumn("node", F.lit(-1).cast("long"))
        for level in self.levels:
            walked = self._children(walked, level).where(beats).select(*goal.columns, "node")
        rest = self._children(walked.where("node != done"), self.labels, "label").where(beats)
        more = rest.groupBy("vid").agg(F.min(best).alias("best"), F.count("*").alias("scored"))
        found = first.select("vid", "best", "scored").unionByName(more).groupBy("vid").agg(F.min("best").alias("best"), F.sum("scored").alias("scored"))
        return values.select("vid", "value").join(found, "vid").select("value", "best", "scored")


def nearest_label(df: DataFrame, column: str, candidates, output: str = "nearest_label",
                  distance: str | None = "distance", label: str | None = None,
                  order_by: str | None = None, scored: str | None = None) -> DataFrame:
    """Append the nearest candidate (and optionally its distance) to ``df``.

    ``candidates`` is a list of labels, or a DataFrame with ``label`` and
    ``order_by`` columns naming and ordering them; of labels with one order the
    smaller text is the earlier.  A null value has no nearest label, nor has any
    value where the candidate table is empty.  ``scored`` names a further column:
    how many candidates were compared with the value.  A data column with the name
    of an added one raises.
    """
    added = [c for c in (output, distance, scored) if c]
    taken = [c for c in (*added, _VALUE, _BEST, _SCORED) if c in df.columns]
    if taken:
        raise ValueError(f"the records have columns {taken}; pass output=, distance= or scored=, or rename them")
    values = df.select(named(column).cast("string").alias(_VALUE)).where(F.col(_VALUE).isNotNull()).distinct()
    if not isinstance(candidates, DataFrame):
        candidates = [str(c) for c in candidates]
        if sum(map(len, candidates)) > MAX_CANDIDATE_CHARS:
            rows = list(enumerate(candidates))
            candidates, label, order_by = df.sparkSession.createDataFrame(rows, "place int, label string"), "label", "place"
    if isinstance(candidates, DataFrame):
        if label is None or order_by is None:
            raise ValueError("a candidate table needs label= and order_by=")
        found = LabelTree(candidates, label, order_by).nearest(values.withColumnRenamed(_VALUE, "value"))
        best = found.select(F.col("value").alias(_VALUE), F.col("best").alias(_BEST), F.col("scored").alias(_SCORED))
        pick, far = F.col(f"{_BEST}.label"), F.col(f"{_BEST}.distance")
    else:
        best = values.withColumns({_BEST: nearest_scored(F.col(_VALUE), candidates), _SCORED: F.lit(len(candidates)).cast("long")})
        pick, far = F.get(_literal(candidates), F.col(f"{_BEST}.i")), F.col(f"{_BEST}.d")
    joined = df.join(best, named(column).cast("string") == F.col(_VALUE), "left")
    values_of = {output: pick, distance: far, scored: F.col(_SCORED)}
    return joined.select(*[named(c) for c in df.columns], *[values_of[c].alias(c) for c in added])
