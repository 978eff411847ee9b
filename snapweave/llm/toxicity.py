"""Toxicity: texts restored from obfuscation, then scored by what their words tell.

Three things are learned.  The character model that restoration needs comes from
the trigrams of every text (:mod:`.deobfuscate`); labels play no part in it.  Signs are whole
words (of bounded length) and beginnings of words, as 64-bit hashes; each counts the labelled texts
that hold it, and one that is surely commoner in toxic texts has a weight, the low
end of its log-odds.  A text's evidence is its strongest sign, the sum over its words and that
sum by length; a logistic regression on these few numbers gives the score.
Evidence of a text that taught the weights is taken without its own share.

The signs and the regression are fitted on at most ``max_labels`` labelled rows
(all, unless there are more; then chosen by hash).  Only text enters a score.

Defined results: a null or empty text has no evidence and gets the score of a text
without any; rows with a null id are never learned from and are not held out;
where labels of one id differ the highest counts, other labels than 0 and 1 and
nulls do not; without labels of both classes every text gets one same score, under
a half unless most labels are 1; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged
from .deobfuscate import SYMBOLS, Restorer, chunks, code_points, count_trigrams, letters, surprise

WHOLE = 32                # a longer word is known by its beginnings alone
SEED, FACTOR = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3)    # Fixed values: FNV-1a


@dataclass(frozen=True)
class ToxicityParams:
    max_labels: int = 200_000     # labelled rows that the signs and the regression are fitted on
    beginnings: tuple[int, ...] = (3, 4, 5, 6)
    min_texts: int = 3            # toxic texts that must hold a sign
    sure: float = 3.0             # standard errors above even odds
    ridge: float = 1e-2
    steps: int = 30


@dataclass(frozen=True)
class ToxicityModel:
    """The costs of the character model, the signs' weights and the regression."""

    costs: np.ndarray
    signs: np.ndarray             # hashes, rising
    weights: np.ndarray           # (3, signs): by all labels, without one toxic text, without one other text
    regression: np.ndarray        # (centre, spread, coefficient) of each input
    constant: float               # the score where there is no regression


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ------------------------------------------------------------------ character model

def character_costs(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Surprise of each letter after two others, from the trigrams of all texts."""
    def run(batches):
        counts = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in batches:
            count_trigrams(batch.column(0).to_pylist(), counts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["i", "n"])

    parts = docs.select(F.col(quoted(text)).alias("text")).mapInArrow(run, "i long, n long")
    counts = np.zeros(SYMBOLS ** 3, np.int64)
    for r in parts.groupBy("i").agg(F.sum("n").alias("n")).collect():       # bounded by the alphabet
        counts[r["i"]] = r["n"]
    return surprise(counts)


def restore_texts(docs: DataFrame, costs: np.ndarray, text: str = "text", output: str = "restored") -> DataFrame:
    """``docs`` with the restored text beside the text."""
    held = docs.sparkSession.sparkContext.broadcast(costs)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        restorer = Restorer(held.value)
        restored = pd.Series(restorer.restore_all(texts.fillna("").tolist()), index=texts.index)
        return restored.where(texts.notna(), None)

    return docs.withColumn(output, run(F.col(quoted(text))))


# ------------------------------------------------------------------ signs

def word_signs(texts: list[str], p: ToxicityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hashes, which hashes count) of each word; a row of hashes is the whole word, then its beginnings."""
    points = code_points("\n".join(texts).lower())
    letter = np.concatenate(([False], letters(points), [False]))
    start = np.flatnonzero(letter[1:-1] & ~letter[:-2])
    length = np.flatnonzero(letter[1:-1] & ~letter[2:]) + 1 - start
    number = np.searchsorted(np.cumsum([len(t.lower()) + 1 for t in texts]), start, side="right")
    hashes = np.zeros((1 + len(p.beginnings), len(start)), np.uint64)
    counts = np.zeros(hashes.shape, bool)
    counts[0] = length <= WHOLE
    h, some = np.full(len(start), SEED), np.arange(len(start))
    for k in range(1, WHOLE + 1):
        some = some[length[some] >= k]
        if not len(some):
            break
        h[some] = (h[some] ^ points[start[some] + k - 1]) * FACTOR
        if k in p.beginnings:
            row = 1 + p.beginnings.index(k)
            hashes[row, some], counts[row, some] = h[some], True
    hashes[0] = (h ^ np.uint64(ord("$"))) * FACTOR
    return number, hashes, counts


def evidence(texts: list[str], signs: np.ndarray, weights: np.ndarray, p: ToxicityParams) -> np.ndarray:
    """The numbers of each text: strongest sign, sum over its words, the sum by length, and their squares."""
    out = []
    for held in chunks(texts):
        number, hashes, counts = word_signs(held, p)
        weight = np.zeros(len(number))
        if len(signs):
            for row, known in zip(hashes, counts, strict=True):
                at = np.minimum(np.searchsorted(signs, row), len(signs) - 1)
                np.maximum(weight, np.where(known & (signs[at] == row), weights[at], 0.0), out=weight)
        strongest = np.zeros(len(held))
        np.maximum.at(strongest, number, weight)
        total, words = (np.bincount(number, w, minlength=len(held)) for w in (weight, None))
        x = np.stack([strongest, np.log1p(total), np.log1p(1000 * total / (20 + words))], axis=1)
        out.append(np.hstack([x, x ** 2]))
    return np.vstack(out) if out else np.zeros((0, 6))


def sign_weight(toxic: Column, other: Column, n_toxic: int, n_other: int, p: ToxicityParams) -> Column:
    """Low end of the log-odds of a sign held by so many texts; 0 where it is not sure."""
    odds = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((other + 0.5) / (n_other + 1))
    error = F.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
    return F.when((toxic >= p.min_texts) & (odds > p.sure * error), odds - (p.sure - 1) * error).otherwise(0.0)


def _sign_counts(train: DataFrame, p: ToxicityParams) -> DataFrame:
    """``sign, toxic, other``: labelled texts that hold each sign."""
    def held_signs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each sign that a text holds, once, with the text's number."""
        number, hashes, counts = word_signs(texts, p)
        found = [np.unique(np.stack([number[c].astype(np.uint64), h[c]]), axis=1) for h, c in zip(hashes, counts, strict=True)]
        both = np.concatenate(found, axis=1)
        return both[0].astype(np.int64), both[1]

    def run(batches):
        for batch in batches:
            labels = np.array(batch.column("toxic").to_pylist(), np.int64)
            done = 0
            for texts in chunks(batch.column("restored").to_pylist()):
                number, sign = held_signs(texts)
                label = labels[done:done + len(texts)][number]
                done += len(texts)
                # summed within a chunk, so common signs travel once
                kinds, where = np.unique(sign, return_inverse=True)
                toxic, other = (np.bincount(where, w, minlength=len(kinds)).astype(np.int64) for w in (label, 1 - label))
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(toxic), pa.array(other)], names=["sign", "toxic", "other"])

    parts = train.select("restored", "toxic").mapInArrow(run, "sign long, toxic long, other long")
    return parts.groupBy("sign").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def sure_signs(train: DataFrame, n_toxic: int, n_other: int, p: ToxicityParams) -> tuple[np.ndarray, np.ndarray]:
    """The signs with a weight, and their weights; all others stay in the cluster."""
    toxic, other = F.col("toxic"), F.col("other")
    weights = F.array(sign_weight(toxic, other, n_toxic, n_other, p), sign_weight(toxic - 1, other, n_toxic - 1, n_other, p),
                      sign_weight(toxic, F.greatest(other - 1, F.lit(0)), n_toxic, n_other - 1, p))
    known = _sign_counts(train, p).where(toxic >= p.min_texts).select("sign", weights.alias("w")).where(F.array_max("w") > 0)
    rows = sorted((r["sign"] % (1 << 64), r["w"]) for r in known.collect())
    return np.array([s for s, _ in rows], np.uint64), np.array([w for _, w in rows]).reshape(-1, 3).T


def _evidence_rows(train: DataFrame, signs: np.ndarray, weights: np.ndarray, p: ToxicityParams) -> list:
    """(inputs, label) of each learning text, its own share taken out; few numbers for a bounded number of rows."""
    held = train.sparkSession.sparkContext.broadcast((signs, weights))

    def run(batches):
        signs, weights = held.value
        for batch in batches:
            texts, labels = batch.column("restored").to_pylist(), np.array(batch.column("toxic").to_pylist(), np.int64)
            x = np.where(labels[:, None] == 1, evidence(texts, signs, weights[1], p), evidence(texts, signs, weights[2], p))
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(labels, pa.int32())], names=["x", "y"])

    return train.select("restored", "toxic").mapInArrow(run, "x array<double>, y int").collect()


def logistic(x: np.ndarray, y: np.ndarray, p: ToxicityParams) -> np.ndarray:
    """(centre, spread, coefficient) rows of a ridge logistic regression by Newton steps; the first input is constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    centre, spread = x.mean(axis=0), x.std(axis=0)
    centre[0], spread[0] = 0.0, 1.0
    spread[spread == 0] = 1.0
    z, w = (x - centre) / spread, np.zeros(x.shape[1])
    for _ in range(p.steps):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (y - q) - p.ridge * w
        w = w + np.linalg.solve(z.T @ (z * (q * (1 - q))[:, None]) + p.ridge * np.eye(len(w)), slope)
    return np.stack([centre, spread, w])


def learn(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Learn from ``docs`` (texts alone) and the rows of ``labels`` outside the held-out fold."""
    p = params
    costs = character_costs(docs, text)
    known = (labels.select(F.col(quoted(doc_id)).alias("__id"), F.col(quoted(label)).cast("int").alias("toxic"))
             .where("__id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("__id")))
             .groupBy("__id").agg(F.max("toxic").alias("toxic")))
    n = known.count()
    if n > p.max_labels:
        share = F.shiftrightunsigned(F.xxhash64(F.lit(11), "__id"), 11) / F.lit(float(1 << 53))
        known = known.where(share < 0.9 * p.max_labels / n)
    # at most max_labels narrow rows, so they go to the texts, not the texts to them
    texts = docs.select(F.col(quoted(doc_id)).alias("__id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    train = staged(restore_texts(texts.join(F.broadcast(known), "__id"), costs).select("restored", "toxic"), "toxic-train")
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    constant = (n_toxic + 0.5) / (n_toxic + n_other + 2)
    if not n_toxic or not n_other:
        return ToxicityModel(costs, np.zeros(0, np.uint64), np.zeros((3, 0)), np.zeros((3, 0)), constant)
    signs, weights = sure_signs(train, n_toxic, n_other, p)
    taught = _evidence_rows(train, signs, weights, p)
    x = np.array([r["x"] for r in taught])
    return ToxicityModel(costs, signs, weights, logistic(x, np.array([r["y"] for r in taught]), p), constant)


# ------------------------------------------------------------------ scores

def score_texts(docs: DataFrame, model: ToxicityModel, params: ToxicityParams = ToxicityParams(), doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, score, predicted``; only the text is read for a score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        m = held.value
        if not m.regression.shape[1]:
            return pd.Series(np.full(len(texts), m.constant))
        rows = evidence(Restorer(m.costs).restore_all(texts.fillna("").tolist()), m.signs, m.weights[0], params)
        centre, spread, w = m.regression
        z = (np.hstack([np.ones((len(rows), 1)), rows]) - centre) / spread
        return pd.Series(1 / (1 + np.exp(-np.clip(z @ w, -500, 500))))

    scored = docs.select(F.col(quoted(doc_id)).alias("doc_id"), run(F.col(quoted(text))).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
