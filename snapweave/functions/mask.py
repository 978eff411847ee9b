"""Presence masks: one ``'0'``/``'1'`` character per snapshot.

A masked table carries a ``diffmask`` string column whose i-th character says
whether the record was present in snapshot i of the mask legend.  The legend
(the ordered snapshot labels) lives in the column metadata under ``diffdirs``,
not in the rows, so it costs nothing per record.

While aggregating, masks are held as ``BIGINT`` words instead of strings so
Spark can OR them with ``bit_or`` inside a hash aggregate (partial + final,
fixed-width buffer).  Word k covers legend positions ``63k .. 63k+62``; inside a
word the leftmost character is the highest bit, so rendering is
``lpad(bin(word), width, '0')`` and the concatenation over words is the mask.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values shared with the on-disk format of masked tables.
MASK_COLUMN = "diffmask"
LEGEND_KEY = "diffdirs"
ONE = "1"
ZERO = "0"

WORD_BITS = 63  # a signed BIGINT holds 63 value bits


@dataclass(frozen=True)
class MaskLayout:
    """Maps legend positions onto 63-bit words."""

    labels: tuple[str, ...]

    @classmethod
    def of(cls, labels) -> "MaskLayout":
        labels = tuple(labels)
        if not labels:
            raise ValueError("a mask legend needs at least one snapshot label")
        if len(set(labels)) != len(labels):
            raise ValueError(f"duplicate labels in mask legend: {labels}")
        return cls(labels)

    @property
    def size(self) -> int:
        return len(self.labels)

    @property
    def num_words(self) -> int:
        return (self.size + WORD_BITS - 1) // WORD_BITS

    def width(self, word: int) -> int:
        return min(WORD_BITS, self.size - WORD_BITS * word)

    def locate(self, position: int) -> tuple[int, int]:
        """(word index, bit index) of a legend position."""
        word, offset = divmod(position, WORD_BITS)
        return word, self.width(word) - 1 - offset

    def index(self, label: str) -> int:
        try:
            return self.labels.index(label)
        except ValueError:
            raise KeyError(f"label {label!r} is not in the mask legend {list(self.labels)}") from None

    def word_names(self, prefix: str = "__w", taken=()) -> list[str]:
        """Names of the word columns, none of them among ``taken``."""
        while any(name.lower().startswith(prefix) for name in taken):
            prefix += "_"
        return [f"{prefix}{k}" for k in range(self.num_words)]


# 2 ** (LISTED - 1) masks have a given position set; Parquet lists up to ten values.
LISTED = 4


def one_hot_words(layout: MaskLayout, position: int) -> list[Column]:
    """Word literals with the single bit of ``position`` set (a raw snapshot)."""
    word, bit = layout.locate(position)
    return [F.lit(1 << bit if k == word else 0).cast("bigint") for k in range(layout.num_words)]


def realign_words(mask: Column, local_labels, layout: MaskLayout) -> list[Column]:
    """Word expressions placing a mask written in ``local_labels`` order into ``layout``.

    Runs of local positions that land on consecutive bits of one word are parsed
    in one ``conv(substring(..), 2, 10)``, so re-merging an already merged table
    (the incremental case) costs a handful of substring parses per row.
    """
    targets = [layout.index(label) for label in local_labels]
    mask = checked_mask(mask, len(targets))
    runs: list[tuple[int, int, int, int]] = []  # (local start, length, word, lowest bit)
    for i, pos in enumerate(targets):
        word, bit = layout.locate(pos)
        if runs:
            start, length, rword, low = runs[-1]
            if rword == word and low - 1 == bit and start + length == i:
                runs[-1] = (start, length + 1, word, bit)
                continue
        runs.append((i, 1, word, bit))

    per_word: list[list[Column]] = [[] for _ in range(layout.num_words)]
    for start, length, word, low in runs:
        chunk = F.substring(mask, start + 1, length)
        if length == 1:
            value = F.when(chunk == ONE, F.lit(1 << low).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        else:
            value = F.shiftleft(F.conv(chunk, 2, 10).cast("bigint"), low)
        per_word[word].append(value)
    return [reduce(lambda a, b: a.bitwiseOR(b), parts) if parts else F.lit(0).cast("bigint")
            for parts in per_word]


def checked_mask(mask: Column, size: int) -> Column:
    """``mask``, or an error where it is null or not as long as its legend."""
    fault = F.concat(F.lit(f"a mask of the legend's {size} snapshots is expected, not "), F.coalesce(mask, F.lit("null")))
    return F.when(F.length(mask) == size, mask).otherwise(F.raise_error(fault))


def fits_legend(mask: Column, size: int) -> Column:
    """True, or an error where a mask is not as long as its legend; a null mask is let pass."""
    fault = F.concat(F.lit(f"a mask of the legend's {size} snapshots is expected, not "), mask)
    return F.when(F.coalesce(F.length(mask), F.lit(size)) == size, F.lit(True)).otherwise(F.raise_error(fault).cast("boolean"))


def render_mask(words: list[Column], layout: MaskLayout) -> Column:
    """Mask string from word columns."""
    pieces = [F.lpad(F.bin(w), layout.width(k), ZERO) for k, w in enumerate(words)]
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def bit_is_set(mask: Column, position: int, size: int | None = None) -> Column:
    """True where snapshot ``position`` (0-based) of a ``size``-snapshot legend is present.

    The first and the last position are written as prefix / suffix tests, which
    Spark pushes into Parquet scans (``StringStartsWith`` / ``StringEndsWith``).
    A middle position of a legend of at most ``LISTED`` snapshots is membership
    in its few masks, which is pushed as well; of a longer one it is a plain
    character test.
    """
    if position == 0:
        return mask.startswith(ONE)
    if size is not None and position == size - 1:
        return mask.endswith(ONE) & (F.length(mask) == size)
    if size is not None and size <= LISTED:
        masks = [format(m, f"0{size}b") for m in range(1 << size)]
        return mask.isin([m for m in masks if m[position] == ONE])
    return F.substring(mask, position + 1, 1) == ONE


def first_set(mask: Column) -> Column:
    """1-based position of the first present snapshot, 0 when none."""
    return F.locate(ONE, mask)


def last_set(mask: Column) -> Column:
    """1-based position of the last present snapshot, 0 when none."""
    from_end = F.locate(ONE, F.reverse(mask))
    return F.when(from_end == 0, F.lit(0)).otherwise(F.length(mask) - from_end + 1)


# ---------------------------------------------------------------- legends

def legend_of(df: DataFrame, column: str = MASK_COLUMN) -> list[str] | None:
    """Labels stored on the mask column, or None when the schema carries none."""
    if column not in df.columns:
        return None
    labels = df.schema[column].metadata.get(LEGEND_KEY)
    if labels is None:
        return None
    if isinstance(labels, str):  # tolerate a comma-joined legend
        labels = labels.split(",") if labels else []
    return list(labels)


def resolve_legend(df: DataFrame, snapshots=None, column: str = MASK_COLUMN) -> list[str]:
    """Explicit legend if given, else the one in the schema; fail loudly otherwise."""
    if column not in df.columns:
        raise ValueError(f"input has no {column!r} column; it is not a masked table")
    labels = list(snapshots) if snapshots is not None else legend_of(df, column)
    if not labels:
        raise ValueError(
            f"no snapshot legend: the {column!r} column carries no {LEGEND_KEY!r} metadata "
            "(formats such as JSON or ORC drop it); pass snapshots=[...]")
    return labels


def with_legend(mask: Column, labels, name: str = MASK_COLUMN) -> Column:
    """Alias a mask expression and attach its legend as column metadata."""
    return mask.alias(name, metadata={LEGEND_KEY: list(labels)})


def attach_legend(df: DataFrame, labels, column: str = MASK_COLUMN) -> DataFrame:
    """Return ``df`` with the legend set on its mask column (column order kept)."""
    return df.select(*[with_legend(F.col(c), labels, c) if c == column else F.col(c)
                       for c in df.columns])
