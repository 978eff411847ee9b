"""Merge of many imports: one frame with a label column, a legend of any length.

:func:`merge` takes a frame per import and keeps a BIGINT column per 63 imports, so a
legend of thousands makes a plan of thousands of branches and of wide aggregates.
Here the imports are one frame (one scan of a root, say) whose rows name their import,
and a record's mask is held as rows ``(record, word number, word)``:

1. each row becomes its word, a history's record one row per word that is not zero;
2. one hash aggregate ORs the words of (record, word number), copies collapsing
   before the shuffle;
3. a second one gathers a record's words, at most ``ceil(n / 63)``, and writes its mask.

The plan is of the same width for 5 imports and for 5,000; it costs a second exchange
of the distinct (record, word) pairs.  The labels are on the driver, as in any legend,
and are broadcast as one row each.

Defined results: those of :func:`merge`, which it equals on the same imports.  A row
with a null label, or one that given ``labels`` do not list, raises; a listed import
without rows has zeros; without any label there is no legend, which raises; the
legend of a history comes from its metadata or from ``legend``; the names ``__word``,
``__bits`` and ``__label`` change where a data column has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mask import MASK_COLUMN, WORD_BITS, ZERO, checked_mask, resolve_legend, with_legend
from ..plans.schema import conform_columns, named, reconcile

_WORDS = "array<struct<word:int,bits:bigint>>"


def _free(name: str, taken) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _realigned(mask: Column, inner: list[str], positions: dict[str, int], size: int) -> Column:
    """A mask over ``inner`` as a mask over the whole legend, in time linear in its length."""
    mask = checked_mask(mask, len(inner))
    if [positions[label] for label in inner] == list(range(len(inner))):
        return F.rpad(mask, size, ZERO)      # new labels come last
    source = [0] * size
    for i, label in enumerate(inner):
        source[positions[label]] = i + 1
    order = F.from_json(F.lit(str(source)), "array<int>")
    return F.transform(F.array(F.split(mask, "")), lambda chars: F.array_join(
        F.transform(order, lambda i: F.when(i == 0, ZERO).otherwise(F.get(chars, i - 1))), ""))[0]


def _words(mask: Column, size: int) -> Column:
    """The words of a mask that are not zero; one zero word where all are."""
    count = -(-size // WORD_BITS)
    every = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda w: F.struct(w.alias("word"), F.conv(
        F.rpad(F.substring(mask, w * WORD_BITS + 1, F.lit(WORD_BITS)), WORD_BITS, ZERO), 2, 10).cast("bigint").alias("bits")))
    some = F.filter(every, lambda x: x["bits"] != 0)
    none = F.array(F.struct(F.lit(0).alias("word"), F.lit(0).cast("bigint").alias("bits")))
    return F.when(F.size(some) > 0, some.cast(_WORDS)).otherwise(none.cast(_WORDS))


def _rendered(words: Column, size: int) -> Column:
    """The mask of a record's words: each with the zeros since the one before, then zeros to the end."""
    def pieces(ordered):
        def piece(x, i):
            before = F.when(i == 0, F.lit(-1)).otherwise(F.get(ordered, i - 1)["word"])
            gap = F.repeat(F.lit(ZERO), (x["word"] - before - 1) * WORD_BITS)
            return F.concat(gap, F.lpad(F.bin(x["bits"]), WORD_BITS, ZERO))
        return F.array_join(F.transform(ordered, piece), "")
    return F.rpad(F.transform(F.array(F.array_sort(words)), pieces)[0], size, ZERO)


def merge_labelled(imports: DataFrame, label: str, history: DataFrame | None = None, labels=None,
                   legend=None) -> DataFrame:
    """Merge the imports named by the column ``label``, and a masked ``history`` if given.

    ``labels`` lists the imports of the frame and saves the pass that finds them.
    """
    if label not in imports.columns:
        raise ValueError(f"the imports have no column {label!r}")
    if MASK_COLUMN in imports.columns:
        raise ValueError(f"the imports have a column {MASK_COLUMN!r}; pass a merged table as history")
    spark = imports.sparkSession
    inner = list(resolve_legend(history, legend)) if history is not None else []
    key = named(label).cast("string")
    if labels is None:
        labels = [r[0] for r in imports.select(key.alias("label")).distinct().where("label IS NOT NULL").collect()]
    every = sorted({*map(str, labels), *inner})
    if not every:
        raise ValueError("merge needs at least one import")
    size, positions = len(every), {name: i for i, name in enumerate(every)}

    target = reconcile([df.schema for df in (imports, history) if df is not None], exclude={MASK_COLUMN, label})
    names = target.fieldNames()
    word, bits, known = (_free(n, names) for n in ("__word", "__bits", "__label"))
    keys = [named(n) for n in names]

    listed = spark.createDataFrame([(name, positions[name]) for name in map(str, dict.fromkeys(labels))],
                                   T.StructType([T.StructField(known, T.StringType()), T.StructField(word, T.IntegerType())]))
    # a row's place in the legend: the bit of its word, the leftmost position highest
    rows = imports.select(*conform_columns(imports, target), key.alias(known)).join(F.broadcast(listed), known, "left")
    fault = F.raise_error(F.concat(F.lit("a row of no listed import: "), F.coalesce(F.col(known), F.lit("null")))).cast("int")
    place = F.coalesce(F.col(word), fault)
    one = F.lit(1).cast("bigint")
    pairs = rows.select(*keys, F.floor(place / WORD_BITS).cast("int").alias(word),
                        F.call_function("shiftleft", one, (WORD_BITS - 1 - place % WORD_BITS).cast("int")).alias(bits))
    if history is not None:
        mask = _realigned(named(MASK_COLUMN), inner, positions, size)
        old = history.select(*conform_columns(history, target), F.explode(_words(mask, size)).alias(word))
        pairs = pairs.unionByName(old.select(*keys, F.col(word)["word"].alias(word), F.col(word)["bits"].alias(bits)))
    held = pairs.groupBy(*keys, word).agg(F.bit_or(bits).alias(bits))
    gathered = held.groupBy(*keys).agg(F.collect_list(F.struct(F.col(word).alias("word"), F.col(bits).alias("bits"))).alias(word))
    return gathered.select(*keys, with_legend(_rendered(F.col(word), size), every))
