import random
import re

from snapweave.llm import decontaminate as D

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(doc, items, window=10):
    w = words(doc)
    hit, ids = set(), set()
    for i, text in items:
        t = words(text)
        for s in {tuple(t[k:k + window]) for k in range(max(len(t) - window + 1, 1))} - {()}:
            for k in range(len(w) - len(s) + 1):
                if tuple(w[k:k + len(s)]) == s:
                    hit.update(range(k, k + len(s)))
                    ids.add(str(i))
    return len(w), len(hit), sorted(ids)


def test_automaton_on_random_words():
    for seed in range(200):
        r = random.Random(seed)
        window = r.choice([2, 3, 4])
        items = [(str(k), [r.choice((b"a", b"b", b"c")) for _ in range(r.randrange(9))]) for k in range(r.randrange(1, 6))]
        doc = [r.choice((b"a", b"b", b"c", b"d")) for _ in range(30)]
        found = set()
        automaton = D.Automaton(items, window)
        hits, _ = automaton.scan(doc, None, found)
        want = brute(b" ".join(doc).decode(), [(i, b" ".join(w).decode()) for i, w in items], window)
        assert (sum(hits or b""), sorted({automaton.ids[k] for k in found})) == want[1:]


def test_whole_table(spark, documents, doc_rows):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    listed = [(r["item_id"], r["text"]) for r in items.collect()]
    sizes = {i: len(words(t)) for i, t in listed}
    grams = {}
    for i, t in listed:
        w = words(t)
        for k in range(max(len(w) - 9, 1)):
            grams.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    assert min(sizes.values()) >= 10
    want = {}
    for i, t, _, _ in doc_rows:
        w = words(t)
        at = [k for k in range(len(w) - 9) if tuple(w[k:k + 10]) in grams]
        want[i] = (len(w), len({p for k in at for p in range(k, k + 10)}),
                   sorted(set().union(*(grams[tuple(w[k:k + 10])] for k in at))))
    for params in (D.DecontaminationParams(), D.DecontaminationParams(shard_words=300)):
        rows = D.contamination(documents, items, params).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == want
    assert any(v[1] for v in want.values())
    assert not [r for r in D.contamination(D.decontaminate(documents, items), items).collect() if r["contaminated"]]


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "Another TEXT"), (1, "Another text"), (2, None), (3, "!!!"), (None, "漢字 漢字"), (4, "")],
                                  "item_id long, text string")
    rows = D.contamination(edge_docs, items).collect()
    assert len(rows) == edge_docs.count()
    hit = {r["doc_id"]: (r["n_hit"], r["items"]) for r in rows if r["contaminated"]}
    assert hit == {1: (6, ["1"]), 6: (2, [])}
    clean = D.decontaminate(edge_docs, items)
    assert clean.columns == edge_docs.columns
    assert "another" not in " ".join(r["text"] or "" for r in clean.where("doc_id = 1").collect())
    assert D.contamination(no_docs, items).collect() == []
    none = D.contamination(edge_docs, items.limit(0)).collect()
    assert {r["n_hit"] for r in none} == {0} and sum(r["n_words"] for r in none) == sum(r["n_words"] for r in rows)
    assert clean.schema == edge_docs.schema


def test_items_longer_than_a_shard(spark):
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.choice((3, 12, 90))))) for k in range(30)]
    items += [(100 + k, items[0][1]) for k in range(3)]      # one text under several ids
    docs = [(k, " ".join([r.choice(vocabulary) for _ in range(5)] + items[k % 30][1].split()[:40])) for k in range(40)]
    table = spark.createDataFrame(items, "item_id long, text string")
    params = D.DecontaminationParams(window=4, shard_words=25)
    folder, names = D.write_shards(table, params)
    assert len(names) > sum(len(t.split()) for _, t in items) / 25
    rows = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), table, params).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == {i: brute(t, items, 4) for i, t in docs}


def test_pack_keeps_every_window_within_the_limit():
    p = D.DecontaminationParams(window=4, shard_words=10)
    for seed in range(50):
        r = random.Random(seed)
        rows = [(str(k), b" ".join(b"%d" % r.randrange(50) for _ in range(r.randrange(60)))) for k in range(6)]
        parts = list(D.pack_items(rows, p))
        assert all(sum(len(w) for _, w in part) <= 10 for part in parts)

        def windows(pairs):
            return {(i, tuple(w[k:k + 4])) for i, w in pairs for k in range(max(len(w) - 3, 1)) if w and (len(w) >= 4 or k == 0)}
        assert windows((i, w) for part in parts for i, w in part) == windows((i, t.split()) for i, t in rows)
