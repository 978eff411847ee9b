"""Mutation statistics: which fields change between versions of an entity.

Records of a masked table are grouped by one field (compared as text), each
group is ordered by mask then by all columns, and every pair of neighbours
yields the sorted names of the fields that differ (null equals null) plus
both masks.  :func:`mutation_stats` counts identical results.

Ordering: ``order="reference"`` sorts masks ascending as text, so ``01``
(present only in the later snapshot) comes before ``10``: ``diffmaskIn`` is then
usually the *later* version.  ``order="chronological"`` sorts masks
descending, earliest first appearance first.  Records with a null grouping
value are left out.

Plan (skew-proof).  A per-key window would push a hot key -- say a third of
all rows -- through one task, so groups are handled by size:

* Keys are counted with map-side partial counts; those above the threshold are
  the hot keys.  They stay a (staged) table of at most rows / threshold keys.
  A semi and an anti join part the rows; the hot side is broadcast while its
  counted size allows, and shuffled otherwise.
* Ordinary keys: one hash exchange on the key and ``lead`` over a window per
  key.  Every group is below the hot threshold, so each fits a task.
* Hot keys: the rows are range-partitioned on (key, mask, columns) and written
  once to the shared folder *with their range number as a column*, so every
  later read sees the same ranges.  ``lead`` over (range, key) pairs the rows
  inside a range.  A key's last row in a range is paired with its first row in
  its next range by a window over those end rows, per key.

Either way each key is handled whole by one strategy and both are exact under
any setting.  The counts of :func:`mutation_stats` are one more partially
aggregated exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mask import MASK_COLUMN
from ..plans.schema import named
from ..sources.stage import stage_table
from .compact import TARGET_FILE_BYTES, orderable, plan_bytes

# The mutation record.
FIELDS = "fields"
MASK_IN = "diffmaskIn"
MASK_OUT = "diffmaskOut"
COUNT = "count"

_KEY = "__key"
_PART = "__range"
_HEAD = "__head"
_TAIL = "__tail"
_END = "__end"
_MORE = "__more"
_NEXT = "__next_"
_BITS = "__changed"
_HOT = "__hot"
_RESERVED = (_KEY, _PART, _HEAD, _TAIL, _END, _MORE, _NEXT, _BITS, _HOT)
WORD_BITS = 63

# A group above this many rows is split over several tasks.
HOT_KEY_ROWS = 1_000_000
# Hot keys up to this many, and of at most so many bytes in all, are broadcast to
# part the rows; beyond either the same joins shuffle.
BROADCAST_KEYS = 1_000_000
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32            # what a broadcast row takes beside its key


def _differs(a: Column, b: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):
        a, b = F.array_sort(F.map_entries(a)), F.array_sort(F.map_entries(b))
    return ~a.eqNullSafe(b)


def _mask_order(order: str) -> Column:
    mask = F.col(MASK_COLUMN)
    if order == "reference":
        return mask
    if order == "chronological":
        # Masks share one length, so the complement sorts ascending exactly
        # like the mask sorts descending.
        return F.translate(mask, "01", "10")
    raise ValueError(f"order must be 'reference' or 'chronological', not {order!r}")


def _check(masked: DataFrame, key: str) -> None:
    if MASK_COLUMN not in masked.columns:
        raise ValueError(f"input has no {MASK_COLUMN!r} column")
    if key not in masked.columns or key == MASK_COLUMN:
        raise KeyError(f"grouping field {key!r} is not a data column")
    taken = [c for c in masked.columns if c.lower().startswith(_RESERVED)]
    if taken:
        raise ValueError(f"the records have columns {taken}; rename them, those names are used here")


# Types grouped by the column itself, without a text copy: their text is
# one-to-one with the value, or (timestamps) would be but for the session zone,
# where two instants share one text at a clock change.
_TEXT_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType,
               T.DateType, T.DecimalType, T.TimestampType, T.TimestampNTZType)


class _Layout:
    """Column roles shared by both pair strategies.

    ``key`` names the grouping column of ``keyed``: the field itself when its
    text is one-to-one with its value, else an added text copy.
    """

    def __init__(self, masked: DataFrame, key: str, order: str, as_bits: bool = False):
        _check(masked, key)
        self.as_bits = as_bits
        self.fields = [f for f in masked.schema.fields if f.name != MASK_COLUMN]
        names = [f.name for f in self.fields]
        present = masked.where(named(key).isNotNull())
        if isinstance(masked.schema[key].dataType, _TEXT_EXACT):
            self.key = key
            self.keyed = present.select(*[named(n) for n in names], MASK_COLUMN)
            self.carried = [*names, MASK_COLUMN]
        else:
            self.key = _KEY
            self.keyed = present.select(named(key).cast("string").alias(_KEY),
                                        *[named(n) for n in names], MASK_COLUMN)
            self.carried = [_KEY, *names, MASK_COLUMN]
        self.payload = [*names, MASK_COLUMN]
        self.within_key = [_mask_order(order)] + [orderable(f.name, f.dataType) for f in self.fields]
        self.sort_keys = [named(self.key)] + self.within_key

    @property
    def sorted_fields(self) -> list[T.StructField]:
        return sorted(self.fields, key=lambda f: f.name)

    def bit_names(self) -> list[str]:
        return [f"{_BITS}{k}" for k in range(-(-len(self.fields) // WORD_BITS) or 1)]

    def pairs(self, df: DataFrame, following: dict) -> DataFrame:
        """Pair rows with their successor values (``following[column]``) and name the changes.

        With ``as_bits`` the changed fields come as BIGINT words (bit i of word k
        is sorted field 63k+i), a fixed-width key for counting; :meth:`names`
        turns them back into the sorted name array.
        """
        masks = [F.col(MASK_COLUMN).alias(MASK_IN), following[MASK_COLUMN].alias(MASK_OUT)]
        flags = [_differs(named(f.name), following[f.name], f.dataType) for f in self.sorted_fields]
        if not self.as_bits:
            changed = F.array_compact(F.array(*[
                F.when(flag, F.lit(f.name)) for flag, f in zip(flags, self.sorted_fields)]))
            return df.select(changed.alias(FIELDS), *masks)
        words = []
        for k, name in enumerate(self.bit_names()):
            part = flags[k * WORD_BITS:(k + 1) * WORD_BITS]
            bits = [F.when(flag, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                    for i, flag in enumerate(part)] or [F.lit(0).cast("bigint")]
            words.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(name))
        return df.select(*words, *masks)

    def names(self) -> Column:
        """Sorted names of the fields whose bit is set in the words of :meth:`pairs`."""
        return F.array_compact(F.array(*[
            F.when(F.col(self.bit_names()[i // WORD_BITS]).bitwiseAND(F.lit(1 << (i % WORD_BITS))) != 0,
                   F.lit(f.name))
            for i, f in enumerate(self.sorted_fields)]))


def hot_keys(keyed: DataFrame, key: str, threshold: int) -> DataFrame:
    """``k, rows``: the keys with more than ``threshold`` rows (a lazy, pre-aggregated table)."""
    return (keyed.groupBy(named(key).alias("k")).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > threshold))


def _window_pairs(layout: _Layout, keyed: DataFrame) -> DataFrame:
    """Bounded groups: one hash exchange on the key, then ``lead`` inside each group.

    One ``lead`` per column: a ``lead(struct(...))`` would be pre-projected below
    the exchange and ship every field twice.  The key is never null here, so its
    ``lead`` marks whether a successor exists.
    """
    w = Window.partitionBy(named(layout.key)).orderBy(*layout.within_key)
    following = {c: F.lead(named(c)).over(w).alias(_NEXT + c) for c in layout.payload}
    exists = F.lead(named(layout.key)).over(w).alias(_HEAD)
    walked = keyed.select("*", exists, *following.values()).where(F.col(_HEAD).isNotNull())
    return layout.pairs(walked, {c: named(_NEXT + c) for c in layout.payload})


def _ranged(layout: _Layout, keyed: DataFrame, num_ranges: int) -> DataFrame:
    """Rows with their range number, written once so that the number is data.

    Positional column names, so that any field name can be stored.
    """
    if num_ranges < 1:
        raise ValueError("num_ranges must be positive")
    cut = keyed.repartitionByRange(num_ranges, *layout.sort_keys).withColumn(_PART, F.spark_partition_id())
    names = cut.columns
    stored = stage_table(cut.select(*[named(n).alias(f"c{i}") for i, n in enumerate(names)]), "ranges")
    return stored.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def _range_count(keyed: DataFrame, n_rows: int, hot_key_rows: int) -> int:
    """Ranges for so many hot rows: of about ``hot_key_rows`` rows, but only as many as tasks can use.

    Each range is a task, a file and a block in every shuffle file, and any number of them
    gives the same pairs.  So beyond the shuffle partitions there are only as many as keep
    a range near ``HOT_KEY_ROWS`` rows, which a task takes as it takes an ordinary group,
    and near ``TARGET_FILE_BYTES`` of the input, for wide records.
    """
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(-(-n_rows // hot_key_rows), max(tasks, -(-n_rows // HOT_KEY_ROWS), -(-plan_bytes(keyed) // TARGET_FILE_BYTES)))


def _range_pairs(layout: _Layout, keyed: DataFrame, num_ranges: int) -> DataFrame:
    """Any group size: a global range split, pairs inside ranges, then pairs across their ends."""
    ranged = _ranged(layout, keyed, num_ranges)
    key = named(layout.key)
    w = Window.partitionBy(_PART, key).orderBy(*layout.within_key)
    following = {c: F.lead(named(c)).over(w).alias(_NEXT + c) for c in layout.payload}
    walked = ranged.select("*", F.lag(key).over(w).isNull().alias(_HEAD), F.lead(key).over(w).isNull().alias(_TAIL),
                           *following.values())
    inner = layout.pairs(walked.where(~F.col(_TAIL)), {c: named(_NEXT + c) for c in layout.payload})

    # a key's ends: its first and its last row of each range; a row can be both
    ends = walked.where(F.col(_HEAD) | F.col(_TAIL)).select(
        *[named(c) for c in dict.fromkeys([layout.key, *layout.payload])], _PART, F.explode(F.array_compact(F.array(
            F.when(F.col(_HEAD), F.lit(0)), F.when(F.col(_TAIL), F.lit(1))))).alias(_END))
    across = Window.partitionBy(key).orderBy(_PART, _END)
    following = {c: F.lead(named(c)).over(across).alias(_NEXT + c) for c in layout.payload}
    seams = ends.select("*", F.lead(key).over(across).isNotNull().alias(_MORE), *following.values()).where(
        (F.col(_END) == 1) & F.col(_MORE))
    return inner.unionByName(layout.pairs(seams, {c: named(_NEXT + c) for c in layout.payload}))


def mutation_pairs(masked: DataFrame, key: str, order: str = "reference",
                   hot_key_rows: int = HOT_KEY_ROWS, num_ranges: int | None = None) -> DataFrame:
    """One row per neighbouring pair of versions: ``fields``, ``diffmaskIn``, ``diffmaskOut``.

    Groups of at most ``hot_key_rows`` rows are walked by a per-key window;
    larger (hot) groups by the range split, which spreads one group over many
    tasks.  ``num_ranges`` sets the range count of the latter; by default a
    range has about ``hot_key_rows`` rows, or more where that would make more ranges
    than ``spark.sql.shuffle.partitions``, up to about ``HOT_KEY_ROWS`` or 128 MB.

    The keys are counted as soon as this is called, which reads the key column
    once more; give a stored table (or :func:`snapweave.sources.stage.stage_table`
    of an expensive plan) so that this is a cheap column scan.
    """
    return _pairs(_Layout(masked, key, order), hot_key_rows, num_ranges)


def _pairs(layout: _Layout, hot_key_rows: int, num_ranges: int | None) -> DataFrame:
    if hot_key_rows < 1:
        raise ValueError("hot_key_rows must be positive")
    keyed = layout.keyed
    hot = stage_table(hot_keys(keyed, layout.key, hot_key_rows).withColumnRenamed("k", _HOT), "hot-keys")
    key_bytes = F.octet_length(F.col(_HOT).cast("string")) + ROW_BYTES
    n_keys, n_rows, n_bytes = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0)), F.sum(key_bytes)).first()
    if not n_keys:
        return _window_pairs(layout, keyed)
    names = hot.select(_HOT)
    if n_keys <= BROADCAST_KEYS and n_bytes <= BROADCAST_BYTES:
        names = F.broadcast(names)
    is_hot = named(layout.key) == F.col(_HOT)
    return _window_pairs(layout, keyed.join(names, is_hot, "left_anti")).unionByName(
        _range_pairs(layout, keyed.join(names, is_hot, "left_semi"), num_ranges or _range_count(keyed, n_rows, hot_key_rows)))


def mutation_stats(masked: DataFrame, key: str, order: str = "reference",
                   hot_key_rows: int = HOT_KEY_ROWS, num_ranges: int | None = None) -> DataFrame:
    """Count of each (``fields``, ``diffmaskIn``, ``diffmaskOut``) mutation.

    The pairs are counted by a fixed-width key (changed-field bit words and the
    two masks) with map-side partial counts; field names are attached to the
    counted rows only.
    """
    layout = _Layout(masked, key, order, as_bits=True)
    pairs = _pairs(layout, hot_key_rows, num_ranges)
    counted = pairs.groupBy(*layout.bit_names(), MASK_IN, MASK_OUT).agg(
        F.count(F.lit(1)).alias(COUNT))
    return counted.select(layout.names().alias(FIELDS), MASK_IN, MASK_OUT, COUNT)

