"""Line dedup by a deletion-neighbourhood join.

A line is dropped when an earlier line (by document id, then line number) is
equal to it or, where both have at least ``edit_chars`` code points, within one
edit: one character inserted, deleted or replaced.  In a shorter line one edit may
make another word, so only equality counts there.
Two lines are that close exactly when they agree after deleting one character
of the longer and, if they are equally long, the one at the same place of the
other.  So a line emits, for each place, the hash of what is left and of the
place; equal keys meet, and the earliest line of a key is the candidate.  It is
verified by comparing what is left of both texts, which is an edit distance of at most one.

Emitting every place of every line would multiply the corpus, so the
neighbourhood is built in three steps that lose nothing.  A line first deletes
a whole half, then blocks of the halves that met another line, then single
characters of the blocks that met another line: lines that agree without one
character also agree without any stretch that holds it.

Lines are hashed to 128 bits, grouped and joined by hash; texts travel only for
lines whose half met another.  Counts per key are pre-aggregated.

Defined results: lines without a word, or shorter than ``min_chars`` (1 in the
query and the pipeline, so that every line with a word takes part), are left
alone; a null text has no lines; null ids come last, by line number, then in the order of their texts'
hashes; lines at the same id and
number (repeated rows) do not drop one another; an empty table gives an empty
result; extra columns are carried by :func:`dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged

LAST_CHARS = 16     # a stretch this short is cut into its places


def _digest(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """``id, version, line_no, line`` of the lines that can be dropped."""
    return (docs.select(F.col(quoted(doc_id)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("version"),
                        F.posexplode(F.split(F.col(quoted(text)), "\n")).alias("line_no", "line"))
            .where((F.length("line") >= min_chars) & F.col("line").rlike(r"[^\x20\x09-\x0D]")))


def _position() -> Column:
    # texts without an id are told apart by their hash
    text = F.when(F.col("id").isNull(), F.col("version")).otherwise(0)
    return F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("line_no").alias("line"), text.alias("text"))


def _shared(keys: DataFrame) -> DataFrame:
    """Rows whose ``key`` another line has too."""
    # staged, so that the join reads two plain exchanges and a hot key's rows can be split
    often = staged(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared-keys")
    return keys.join(often, "key")


def _rest(line: Column, longer: Column, start: Column, stop: Column) -> list[Column]:
    """What is left of a line without [start, stop) of the longer one."""
    tail = longer - stop
    return [longer, start, F.substring(line, F.lit(1), start),
            F.when(tail > 0, F.substring(line, F.length(line) - tail + 1, tail)).otherwise("")]


def _half_keys(lines: DataFrame) -> DataFrame:
    """Both halves of each line, as the longer line of a pair and as the shorter."""
    size = F.length("line")
    keys = []
    for more in (0, 1):
        longer = size + more
        middle = F.ceil(longer / 2).cast("int")
        for half, (start, stop) in enumerate(((F.lit(0), middle), (middle, longer))):
            keys.append(F.xxhash64(*_rest(F.col("line"), longer, start, stop)).alias(f"k{more}{half}"))
    return lines.select("id", "version", "line_no", *_digest(F.col("line")), size.alias("size"), *keys)


def _stretches(start: Column, stop: Column, width: Column) -> Column:
    """[start, stop) cut into stretches of ``width``."""
    return F.transform(F.sequence(start, stop - 1, width), lambda s: F.struct(
        s.alias("start"), F.least(s + width, stop).alias("stop")))


def _cut(seed: int, text: Column, start: Column, stop: Column, s: Column, e: Column) -> list[Column]:
    """[s, e) of a stretch [start, stop): the hashes of what lies before and after it, carried on."""
    tail = stop - e
    head = F.substring(text, F.lit(1), s - start)
    rest = F.when(tail > 0, F.substring(text, F.length(text) - tail + 1, tail)).otherwise("")
    return [F.xxhash64(F.lit(seed), F.col(f"a{seed}"), head).alias(f"a{seed}"), F.xxhash64(F.lit(seed), F.col(f"b{seed}"), rest).alias(f"b{seed}")]


def _places(blocks: DataFrame) -> DataFrame:
    """``h1, h2, first, longer, p, v1, v2``: each place p of the blocks with the hash of the line without it.

    A block is cut into sixteenths until a stretch has at most ``LAST_CHARS`` places.  A
    stretch carries its own characters and hashes of those before and after it, so a
    place costs a short hash, and a line costs its length for each round of cuts.
    """
    widest = blocks.agg(F.max(F.col("stop") - F.col("start"))).first()[0] or 0
    tail = F.col("longer") - F.col("stop")
    size = F.length("line")
    ends = [F.substring("line", F.lit(1), F.col("start")), F.when(tail > 0, F.substring(F.col("line"), size - tail + 1, tail)).otherwise("")]
    part = blocks.select("h1", "h2", "first", "longer", "start", "stop", *[
        F.xxhash64(F.lit(seed), end).alias(f"{name}{seed}") for seed in (0, 1) for name, end in zip("ab", ends, strict=True)],
        F.substring(F.col("line"), F.col("start") + 1, size - F.col("start") - tail).alias("part"))
    old = [F.col("part"), F.col("start"), F.col("stop")]
    while widest > LAST_CHARS:
        step = F.greatest(F.lit(LAST_CHARS), F.ceil((F.col("stop") - F.col("start")) / 16).cast("int"))
        s, e = F.col("s.start"), F.col("s.stop")
        inner = F.substring(F.col("part"), s - F.col("start") + 1, F.length("part") - (s - F.col("start")) - (F.col("stop") - e))
        part = part.select("*", F.explode(_stretches(F.col("start"), F.col("stop"), step)).alias("s")).select(
            "h1", "h2", "first", "longer", s.alias("start"), e.alias("stop"), *_cut(0, *old, s, e), *_cut(1, *old, s, e), inner.alias("part"))
        widest = max(LAST_CHARS, -(-widest // 16))
    at = part.select("*", F.explode(F.sequence("start", F.col("stop") - 1)).alias("p"))
    keys = [F.xxhash64(F.col("longer"), F.col("p"), *_cut(seed, *old, F.col("p"), F.col("p") + 1)).alias(f"v{seed + 1}") for seed in (0, 1)]
    return at.select("h1", "h2", "first", "longer", "p", *keys)


def near_lines(lines: DataFrame, edit_chars: int) -> DataFrame:
    """``h1, h2, keeper``: distinct lines with the position of an earlier equal line or, of long enough ones, one within one edit."""
    keyed = _half_keys(lines)
    names = ["k00", "k01", "k10", "k11"]
    distinct = staged(keyed.groupBy("h1", "h2").agg(
        F.min(_position()).alias("first"), F.count("*").alias("n"), F.min("size").alias("size"),
        *[F.min(k).alias(k) for k in names]), "lines")
    halves = distinct.where(F.col("size") >= edit_chars).select("h1", "h2", "first", "size", F.explode(F.array(*[
        F.struct(F.lit(int(k[1])).alias("more"), F.lit(int(k[2])).alias("half"), F.col(k).alias("key")) for k in names]))
        .alias("e")).select("h1", "h2", "first", "size", "e.more", "e.half", "e.key")
    met = _shared(halves).groupBy("h1", "h2").agg(
        F.min("first").alias("first"), F.collect_list(F.struct("more", "half")).alias("halves"))
    # the text of a met line comes from its first place, so copies of a hot line stay where they are
    at = lines.select(_position().alias("first"), *_digest(F.col("line")), "line")
    texts = staged(at.join(met.hint("shuffle_hash"), ["h1", "h2", "first"]).dropDuplicates(["h1", "h2"]), "met-lines")

    longer = F.length("line") + F.col("e.more")
    middle = F.ceil(longer / 2).cast("int")
    half = (texts.select("h1", "h2", "first", "line", F.explode("halves").alias("e"))
            .select("h1", "h2", "first", "line", longer.alias("longer"),
                    F.when(F.col("e.half") == 0, 0).otherwise(middle).alias("start"),
                    F.when(F.col("e.half") == 0, middle).otherwise(longer).alias("stop")))
    # blocks of a sixteenth of the half, but no shorter than sixteen characters
    width = F.greatest(F.lit(16), F.ceil((F.col("stop") - F.col("start")) / 16).cast("int"))
    blocks = (half.where("stop > start").select("h1", "h2", "line", "longer", F.explode(
        _stretches(F.col("start"), F.col("stop"), width)).alias("s"))
        .select("h1", "h2", "longer", "s.start", "s.stop", F.xxhash64(
            *_rest(F.col("line"), F.col("longer"), F.col("s.start"), F.col("s.stop"))).alias("key")))
    close = staged(_shared(blocks).drop("key"), "met-blocks")
    places = _places(close.join(texts.select("h1", "h2", "first", "line"), ["h1", "h2"]))
    earliest = places.groupBy("v1", "v2").agg(F.min("first").alias("near"), F.count("*").alias("n")).where("n > 1")
    candidate = (places.join(earliest, ["v1", "v2"]).where(F.col("near") < F.col("first"))
                 .groupBy("h1", "h2").agg(F.min(F.struct("near", "longer", "p")).alias("e")).select("h1", "h2", "e.near", "e.longer", "e.p"))
    mine = texts.select("h1", "h2", "line")
    other = texts.select(F.col("first").alias("near"), F.col("line").alias("other"))
    # lines that agree without the place are within one edit; Spark's levenshtein takes the square of their length
    left = [F.struct(*_rest(F.col(x), F.col("longer"), F.col("p"), F.col("p") + 1)) for x in ("line", "other")]
    checked = (candidate.join(mine, ["h1", "h2"]).join(other, "near")
               .where(left[0] == left[1]).groupBy("h1", "h2").agg(F.min("near").alias("near")))
    return (distinct.join(checked, ["h1", "h2"], "left").where("n > 1 OR near IS NOT NULL")
            .select("h1", "h2", F.least("first", "near").alias("keeper")))


def dropped_lines(docs: DataFrame, min_chars: int = 20, doc_id: str = "doc_id", text: str = "text", edit_chars: int = 20) -> DataFrame:
    """``id, version, dropped``: per text the sorted numbers of its dropped lines."""
    lines = _lines(docs, doc_id, text, min_chars)
    # staged, so that the join below reads two plain exchanges and a hot line's rows can be split
    keepers = staged(near_lines(lines, edit_chars), "line-keepers")
    rows = lines.select("id", "version", "line_no", *_digest(F.col("line")), _position().alias("at"))
    gone = rows.join(keepers, ["h1", "h2"]).where(F.col("keeper") < F.col("at"))
    return gone.groupBy("id", "version").agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))


def line_report(docs: DataFrame, min_chars: int = 20, doc_id: str = "doc_id", text: str = "text", edit_chars: int = 20) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, dropped`` (line numbers from 0, comma-joined)."""
    gone = dropped_lines(docs, min_chars, doc_id, text, edit_chars)
    mine = docs.select(F.col(quoted(doc_id)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("version"),
                       F.coalesce(F.size(F.split(F.col(quoted(text)), "\n")), F.lit(0)).cast("long").alias("n_lines"))
    same = mine["id"].eqNullSafe(gone["id"]) & (mine["version"] == gone["version"])
    return mine.join(gone, same, "left").select(
        mine["id"].alias("doc_id"), F.greatest("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, doc_id: str = "doc_id", text: str = "text", edit_chars: int = 20) -> DataFrame:
    """``docs`` with dropped lines cut out of the text; a document left without a word goes."""
    gone = dropped_lines(docs, min_chars, doc_id, text, edit_chars).select(
        F.col("id").alias("__id"), F.col("version").alias("__v"), "dropped")
    body = F.col(quoted(text))
    same = F.col(quoted(doc_id)).eqNullSafe(F.col("__id")) & (F.xxhash64(body) == F.col("__v"))
    kept = F.array_join(F.filter(F.split(body, "\n"), lambda line, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    joined = docs.join(gone.withColumnRenamed("dropped", "__gone"), same, "left")
    clean = joined.withColumn("__text", F.when(F.col("__gone").isNull(), body).otherwise(kept))
    out = clean.where(F.col("__gone").isNull() | F.col("__text").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[(F.col("__text") if c == text else F.col(quoted(c))).alias(c) for c in docs.columns])
