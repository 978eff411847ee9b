import math

import numpy as np
import pytest

from snapweave.llm import queries
from snapweave.llm.bidiagonal import right_singular
from snapweave.llm.whitening import whitened_embeddings

SF = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label int, n long, `x.y` string"


def brute(rows, components=16):
    """{(id, component): (n, deviation, whitened, explained)} by numpy's symmetric solver."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), np.int64)
    n, s = len(fit), fit.sum(axis=0)
    z = (n * fit - s) / n
    e, vectors = np.linalg.eigh(z.T @ z / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    out = {}
    for i, row in x.items():
        d = n * np.array(row) - s
        along = (d / n) @ vectors[:, :k] / np.sqrt(e[:k])
        for c in range(k):
            out[i, c + 1] = (n, int((d * d).sum()), along[c], e[c] / e.sum())
    return out


def check(got, want):
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted(want)
    sign = {}
    for r in got:
        n, deviation, along, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation) and abs(r["explained"] / explained - 1) < 1e-6
        assert r["identity_error"] < 1e-4
        if abs(along) > 1e-3:
            sign.setdefault(r["component"], np.sign(along * r["whitened"]))
        assert abs(sign.get(r["component"], 1) * r["whitened"] - along) < 1e-6 or abs(along) <= 1e-3


def test_query_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.op13_whitening(spark, SF).collect(), brute(rows))


@pytest.mark.parametrize("partitions", [1, 40])
def test_repeated_vectors_count_once_and_factors_merge_in_a_tree(spark, partitions):
    r = np.random.default_rng(1)
    v = [r.normal(size=5).astype(np.float32).tolist() for _ in range(60)]
    rows = [(i, v[i % 60] if i < 100 else v[0], 0, i, "q") for i in range(300)]
    got = whitened_embeddings(spark.createDataFrame(rows, ROWS).repartition(partitions)).collect()
    check(got, brute([x[:2] for x in rows]))
    assert got[0]["n"] == 60 and len({r["component"] for r in got}) == 5


def test_edges(spark):
    rows = [(1, [1.0, 2.0], 0, 1, "q"), (1, [1.0, 2.0], 0, 1, "q"), (2, [3.0, 2.0], 0, 1, "q"), (None, [0.0, 2.0], None, None, None),
            (3, None, 0, 1, "q"), (4, [None, 1.0], 0, 1, "q"), (5, [float("nan"), 1.0], 0, 1, "q"), (6, [float("-inf"), 1.0], 0, 1, "q"),
            (7, [], 0, 1, "q"), (8, [1e30, 1.0], 0, 1, "q"), (9, [1.0, 2.0, 3.0], 0, 1, "q")]
    got = whitened_embeddings(spark.createDataFrame(rows, ROWS)).collect()
    # the second dimension never varies, so there is one component
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in got) == [(0, 1, 3), (1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert {r["explained"] for r in got} == {1.0}
    for few in (rows[:2], rows[4:6], []):
        assert whitened_embeddings(spark.createDataFrame(few, ROWS)).collect() == []


@pytest.mark.parametrize("kind", ["random", "graded", "low rank", "ties", "identity"])
def test_right_singular(kind):
    r = np.random.default_rng(3)
    n = 40
    a = {"random": lambda: r.normal(size=(n, n)), "graded": lambda: r.normal(size=(n, n)) * np.logspace(0, -9, n),
         "low rank": lambda: r.normal(size=(n, 7)) @ r.normal(size=(7, n)), "identity": lambda: np.eye(n),
         "ties": lambda: np.linalg.qr(r.normal(size=(n, n)))[0] * np.repeat([5.0, 3.0, 1.0, 0.5], 10) @ np.linalg.qr(r.normal(size=(n, n)))[0]}[kind]()
    sigma, v, kept = right_singular(a, 16)
    want = np.linalg.svd(a)[1]
    assert np.abs(sigma - want).max() < 1e-13 * want[0] and len(kept) == (7 if kind == "low rank" else 16)
    assert np.abs(sigma[:len(kept)] / want[:len(kept)] - 1).max() < 1e-12
    assert np.abs(v.T @ v - np.eye(len(kept))).max() < 1e-11
    assert np.abs(a.T @ (a @ v) - v * kept ** 2).max() < 1e-12 * want[0] ** 2
