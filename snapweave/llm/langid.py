"""Language identification by compression.

Each language gets a zstandard raw-content dictionary made of sample texts.  A
text is lower-cased, compressed whole with every dictionary, and belongs to the language
whose dictionary makes it smallest.  A narrow margin between the two smallest
sizes marks the answer as rejected; the prediction itself is still returned.

The dictionaries are the only thing learned: for each language at most
``sample_docs`` distinct stretches and ``dict_bytes`` bytes.  Texts are chosen by
their hash; one longer than ``stretch_chars`` gives a stretch at a place its hash
names, so a language of long texts only is learned as well.

Defined results: a null text or one without a letter is ``und`` with score 0;
equal sizes go to the language with more learning rows, then by name; without
any learning row every text is ``und``; repeated rows are judged alike; rows
with a null language or a null text are not learned from; ids are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted


@dataclass(frozen=True)
class LanguageParams:
    sample_docs: int = 256
    dict_bytes: int = 1 << 17
    stretch_chars: int = 1 << 14  # at most four bytes each, so half of dict_bytes
    level: int = 3
    min_margin: float = 0.01
    max_languages: int = 500      # refuses more: every text is compressed once for each


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, p: LanguageParams, text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary), the language with the most learning rows first."""
    # the low bits of the hash place the stretch, the high bits choose the text
    mark = F.xxhash64(F.lit(7), "text")
    rows = (docs.select(F.col(quoted(text)).alias("text"), F.col(quoted(lang)).alias("lang"))
            .where("text IS NOT NULL AND lang IS NOT NULL").withColumn("mark", mark))
    counts = {r["lang"]: r for r in rows.groupBy("lang").agg(
        F.count("*").alias("n"), F.approx_count_distinct("mark").alias("texts")).collect()}
    if len(counts) > p.max_languages:
        raise ValueError(f"{len(counts)} languages; max_languages is {p.max_languages}")
    if not counts:
        return []
    # a hash share that leaves about four times the wanted texts, then the exact rank among those
    share = F.shiftrightunsigned("mark", 11) / F.lit(float(1 << 53))
    wanted = F.coalesce(*[F.when(F.col("lang") == name, F.lit(min(1.0, (4.0 * p.sample_docs + 64.0) / max(r["texts"], 1))))
                          for name, r in counts.items()])
    room = F.greatest(F.length("text") - p.stretch_chars, F.lit(0)) + 1
    stretch = F.substring(F.col("text"), F.pmod("mark", room).cast("int") + 1, F.lit(p.stretch_chars))
    # copies fall together before the window, so a text that fills a third of the rows counts once
    chosen = rows.where(share < wanted).select("lang", "mark", F.lower(stretch).alias("text")).distinct()
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("mark", 11), "text")
    sample = (chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.sample_docs)
              .select("lang", "rank", F.col("text").cast("binary").alias("text")).orderBy("lang", "rank"))
    out: dict[str, bytes] = {name: b"" for name in counts}
    for r in sample.toLocalIterator():
        body = bytes(r["text"])
        if len(out[r["lang"]]) + len(body) < p.dict_bytes:
            out[r["lang"]] += body + b"\n"
    names = sorted(out, key=lambda name: (-counts[name]["n"], name))
    return [(name, out[name]) for name in names]


def _classifier(dictionaries, p: LanguageParams):
    @F.pandas_udf("lang string, score double, rejected boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        learned = dictionaries.value
        packers = []
        for _, body in learned:
            d = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=p.level)
            packers.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False,
                                                    write_dict_id=False))
        langs, scores, rejected = [], [], []
        for text in texts:
            if text is None or not learned:
                langs.append("und")
                scores.append(0.0)
                rejected.append(True)
                continue
            sizes = [len(c.compress(text)) for c in packers]
            best = min(range(len(sizes)), key=sizes.__getitem__)
            second = min((s for k, s in enumerate(sizes) if k != best), default=2 * sizes[best])
            margin = (second - sizes[best]) / max(second, 1)
            langs.append(learned[best][0])
            scores.append(margin)
            rejected.append(margin < p.min_margin)
        return pd.DataFrame({"lang": langs, "score": scores, "rejected": rejected})
    return run


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], params: LanguageParams = LanguageParams(),
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, rejected``; only the text is read for it."""
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)
    body = F.col(quoted(text))
    found = _classifier(held, params)(F.lower(F.when(body.rlike(r"\p{L}"), body)).cast("binary"))
    return docs.select(F.col(quoted(doc_id)).alias("doc_id"), found.alias("f")).select(
        "doc_id", F.col("f.lang").alias("lang_pred"), F.col("f.score").alias("score"), F.col("f.rejected").alias("rejected"))
