import math
import random
from itertools import product

import numpy as np
import pytest

from snapweave.llm import queries
from snapweave.llm.deobfuscate import BREAK, CODE, LOOK_ALIKES, SYMBOLS, Restorer, count_trigrams, surprise
from snapweave.llm.toxicity import ToxicityParams, character_costs, held_out, learn, restore_texts, score_texts

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, toxic int, doc string"


def costs_of(texts):
    counts = np.zeros(SYMBOLS ** 3, np.int64)
    count_trigrams(texts, counts)
    return surprise(counts)


@pytest.fixture(scope="module")
def restorer():
    words = "you are an idiot a stupid loser and worthless clown moron trash pathetic in the house with a book today not class tree".split()
    r = random.Random(1)
    return Restorer(costs_of([" ".join(r.choice(words) for _ in range(5000))]))


@pytest.mark.parametrize("seen, meant", [
    ("you 1d10t", "you idiot"), ("l0s3r", "loser"), ("a w0rthl3ss cl0wn", "a worthless clown"), ("tr@sh", "trash"), ("$tup1d", "stupid"),
    ("an i d i o t today", "an idiot today"), ("m.o.r.o.n", "moron"), ("c l 0 w n", "clown"), ("stuuuuupid", "stupid"), ("looooser", "loser"),
    ("the class and a tree", "the class and a tree"), ("in 2014 it was 12.5", "in 2014 it was 12.5"), ("", ""), ("A Book", "A Book")])
def test_restored(restorer, seen, meant):
    assert restorer.restore(seen) == meant


def test_decode_against_every_path(restorer):
    """The Viterbi path costs no more than any path through the lattice."""
    def cost(emitted):
        a = b = BREAK
        total = 0.0
        for code, extra in emitted:
            total += extra
            if code is None or (code == BREAK and b == BREAK):
                continue
            total += restorer.costs[a][b][code]
            a, b = (BREAK, BREAK) if code == BREAK else (b, code)
        return total + (restorer.costs[a][b][BREAK] if b != BREAK else 0.0)

    r = random.Random(2)
    for _ in range(150):
        part = "".join(r.choice("ias10$ .") for _ in range(r.randrange(1, 7)))
        lattice = [restorer._choices(part, k) for k in range(len(part))]
        paths = {}
        for path in product(*lattice):
            text, b = "", BREAK
            for code, letter, _ in path:
                if code is not None and not (code == BREAK and b == BREAK):
                    text, b = text + letter, code
            c = cost([(code, extra) for code, _, extra in path])
            paths[text] = min(c, paths.get(text, math.inf))
        assert paths[restorer.decode(part)] <= min(paths.values()) + 1e-9


def test_costs_are_probabilities_and_counts_cover_all_texts(spark, documents, doc_rows):
    assert set(LOOK_ALIKES) & set(CODE) == set()
    costs = character_costs(documents)
    assert np.allclose(np.exp(-costs).sum(axis=2), 1)
    assert np.allclose(costs, costs_of([t for _, t, _, _ in doc_rows]))


def test_query_on_held_out_rows(spark):
    """Every document once; on the held-out fold toxic rows are found and others left alone."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries.op11_toxicity(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    fold = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    caught = sum(y and p for y, p in fold) / sum(y for y, _ in fold)
    wrong = sum(p and not y for y, p in fold) / sum(not y for y, _ in fold)
    assert len(fold) > 500 and caught > 0.9 and wrong < 0.01


def test_obfuscated_words_score_like_plain_ones(spark):
    r = random.Random(4)
    plain = "the house with a book and trees in town was old but not far from here so they went on foot".split()
    text = lambda extra: " ".join(r.sample(plain, 12) + extra)
    rows = [(i, text(["idiot", "moron"] if i % 4 == 0 else []), i) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, doc string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "y") for i in range(400)], LABELS)
    model = learn(docs, labels)
    asked = ["you 1d10t go", "you i d i o t go", "you m0r0n go", "you iiidiot go", "the old house", "", None]
    scores = {r["doc_id"]: r["score"] for r in score_texts(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    assert all(scores[i] > 0.5 for i in range(4)) and all(scores[i] < 0.1 for i in (4, 5, 6)) and scores[5] == scores[6]


def test_held_out_labels_do_not_matter(spark, documents):
    ids = [(r["doc_id"], r["h"]) for r in documents.select("doc_id", held_out(documents["doc_id"]).alias("h")).collect()]
    seen = []
    for flip in (0, 1):
        labels = spark.createDataFrame([(i, int(i % 3 == 0) ^ (flip and h), "") for i, h in ids], LABELS)
        model = learn(documents, labels)
        seen.append(sorted((r["doc_id"], r["score"]) for r in score_texts(documents, model).collect()))
    assert seen[0] == seen[1]


def test_edges(spark, edge_docs, no_docs, long_text):
    few = [(1, 1, "a"), (1, 0, "a"), (5, 0, "a"), (None, 1, "a"), (6, None, "a"), (7, 3, "a")]
    labels = spark.createDataFrame(few, LABELS)
    for model in (learn(edge_docs, labels), learn(edge_docs, labels.where("toxic = 0")), learn(no_docs, labels.limit(0))):
        scored = score_texts(edge_docs, model).collect()
        assert len(scored) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in scored)
        assert score_texts(no_docs, model).collect() == []
    bounded = learn(edge_docs, labels, ToxicityParams(max_labels=1))
    assert score_texts(edge_docs, bounded).count() == edge_docs.count()
    restored = {r["text"]: r["restored"] for r in restore_texts(edge_docs, costs_of([long_text])).collect()}
    assert restored[None] is None and restored[""] == "" and len(restored[long_text]) > 100_000


def test_long_stretches_cost_linear_work(restorer):
    for part in ("1a" * 50_000, "a " * 50_000, "a" * 100_000, "$" * 100_000, "é1 " * 30_000):
        assert isinstance(restorer.restore(part), str)
