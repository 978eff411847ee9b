"""Expressions and helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stage import stage_table

# The white space that separates words.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_array(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside nested lambdas."""
    return F.transform(F.array(value), body)[0]


def count_chars(text: Column, others: str) -> Column:
    """Code points left after removing every run that matches ``others``."""
    return F.length(F.regexp_replace(text, others, ""))


SPANS = "array<struct<start:int,stop:int,value:string,piece:string>>"
CHUNK = 256


def match_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, stop, value, piece>>``.

    Offsets are code points, ``stop`` exclusive; ``piece`` is the text between the
    match and the one before.  Splitting at the matches gives the pieces, so running
    lengths of pieces and matches are the offsets.  They run within chunks first, as
    appending to one long array would cost the square of the matches.  ``pattern``
    must not match the empty string.
    """
    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc, item):
        begin = acc["at"] + F.length(item["piece"])
        stop = begin + F.length(item["value"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(
            begin.alias("start"), stop.alias("stop"), item["value"].alias("value"), item["piece"].alias("piece")))).alias("out"))

    def chunked(items):
        numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))
        return F.transform(numbers, lambda c: F.aggregate(F.slice(items, c * CHUNK + 1, F.lit(CHUNK)), start, step))

    def joined(chunks):
        offsets = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                              lambda a, c: F.struct((a["at"] + c["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
                              lambda a: a["out"])
        return F.flatten(F.zip_with(chunks, offsets, lambda c, by: F.transform(c["out"], lambda x: F.struct(
            (x["start"] + by).alias("start"), (x["stop"] + by).alias("stop"), x["value"].alias("value"), x["piece"].alias("piece")))))

    def from_found(found):
        pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        items = F.zip_with(pieces, found, lambda p, v: F.struct(p.alias("piece"), v.alias("value")))
        return let(let(items, chunked), joined)

    return F.coalesce(F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), 0), from_found)), none)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    return stage_table(df, f"llm-{name}")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
