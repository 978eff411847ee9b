"""Nearest label over a candidate table: exact, and far fewer comparisons than all pairs."""

import random

import pytest

from snapweave import nearest_label
from snapweave.operators import match
from tests.conftest import SF_SMALL


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(values, candidates):
    """{value: (distance, label)} with ties to the earliest order, nulls first, then the smaller label."""
    out = {}
    for v in values:
        d, _, _, c = min((edits(v, c), o is not None, o or 0, c) for c, o in candidates if c is not None)
        out[v] = (d, c)
    return out


@pytest.mark.parametrize("seed, limits", [(0, {}), (1, {"BROADCAST_NODES": 0, "BROADCAST_LABEL_BYTES": 0}), (2, {"RANGE_LABELS": 50}),
                                          (3, {"FAN_BITS": 6, "RANGE_LABELS": 7})])
def test_against_brute_force(spark, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(match, name, value)
    r = random.Random(seed)
    word = lambda low, high: "".join(r.choice("abcdé ") for _ in range(r.randrange(low, high)))
    candidates = [(word(0, 14), r.randrange(200)) for _ in range(400)] + [("", 5), (None, 1), ("abc", None)]
    values = [word(0, 12) for _ in range(60)] + ["", "é" * 30]
    df = spark.createDataFrame([(i, v, i) for i, v in enumerate(values + values[:9] + [None])], "id int, name string, vid int")
    table = spark.createDataFrame(candidates, "label string, place int")
    got = nearest_label(df, "name", table, label="label", order_by="place", scored="scored").collect()
    want = brute(set(values), candidates)
    assert len(got) == len(values) + 10 and [r["id"] for r in got if r["name"] is None] == [len(values) + 9]
    for row in got:
        assert (row["distance"], row["nearest_label"]) == want.get(row["name"], (None, None))
        assert row["vid"] == row["id"]


def test_bounds_rule_most_pairs_out(spark):
    """Misspelt words against a word list: the answers are exact and few pairs are scored."""
    r = random.Random(7)
    words = sorted({"".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(4, 15))) for _ in range(6000)})
    asked = [w[:k] + "x" + w[k + 1:] for w in r.sample(words, 150) for k in (r.randrange(len(w)),)]
    table = spark.createDataFrame(list(zip(words, range(len(words)))), "label string, place int")
    got = nearest_label(spark.createDataFrame([(a,) for a in asked], "name string"), "name", table, label="label", order_by="place", scored="n").collect()
    want = brute(set(asked), list(zip(words, range(len(words)))))
    assert {g["name"]: (g["distance"], g["nearest_label"]) for g in got} == want
    assert sum(g["n"] for g in got) < 0.3 * len(asked) * len(words)


def test_edges(spark):
    df = spark.createDataFrame([("a",), (None,)], "name string")
    none = spark.createDataFrame([], "label string, place int")
    got = nearest_label(df, "name", none, label="label", order_by="place").collect()
    assert sorted((g["name"] or "", g["nearest_label"], g["distance"]) for g in got) == [("", None, None), ("a", None, None)]
    assert nearest_label(df.limit(0), "name", none, label="label", order_by="place").collect() == []
    same = spark.createDataFrame([("b", 1), ("c", 1), ("b", 0)], "label string, place int")
    assert nearest_label(df, "name", same, label="label", order_by="place").first()["nearest_label"] == "b"


def test_a_list_above_the_literal_bound_becomes_a_table(spark, monkeypatch):
    monkeypatch.setattr(match, "MAX_CANDIDATE_CHARS", 3)
    df = spark.createDataFrame([("asi",)], "name string")
    assert nearest_label(df, "name", ["AFRICA", "asia", "asic"]).first()["nearest_label"] == "asia"


def test_supplier_names_through_the_query(spark):
    import __spark_entry__
    got = __spark_entry__.q_nearest_supplier(spark, SF_SMALL).collect()
    suppliers = [(s["s_name"], s["s_suppkey"]) for s in spark.read.parquet(f"{SF_SMALL}/supplier.parquet").collect()]
    want = brute({g["p_name"] for g in got}, suppliers)
    assert got and all((g["distance"], g["nearest_label"]) == want[g["p_name"]] for g in got)
