import numpy as np
import xxhash
from pyspark.sql import functions as F

from snapweave.llm import simhash


def print_of(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest id of each print's group by comparing all pairs."""
    f = np.array([p for _, p in prints], np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 4
    label = np.arange(len(f))
    while True:
        new = np.where(near, label[None, :], len(f)).min(1)
        if (new == label).all():
            break
        label = new
    out = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            out[label[k]] = min(out.get(label[k], i), i)
    return [out.get(label[k]) for k in range(len(prints))]


def test_whole_table(documents, doc_rows):
    prints = [(i, print_of(t)) for i, t, _, _ in doc_rows]
    want = {(i, f"{p:016x}", g) for (i, p), g in zip(prints, groups(prints))}
    assert {tuple(r) for r in simhash.near_duplicates(documents).collect()} == want
    kept = {r["doc_id"] for r in simhash.keep_one(documents).collect()}
    assert kept == {g for _, _, g in want}


def test_index_equals_all_pairs():
    rng = np.random.default_rng(3)
    f = []
    for b in rng.integers(0, 2**63, 30, dtype=np.uint64):
        for _ in range(70):
            x = int(b)
            for k in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(k)
            f.append(x)
    f = np.unique(np.array(f, np.uint64))
    want = simhash.merge_labels(np.arange(len(f)), *np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4))
    assert (simhash.index_labels(f, 4) == want).all()


def test_tiles_lose_no_link(spark):
    base = 0x0123456789ABCDEF
    prints = [base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20) if a < b]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(df, 4, 2, tile=16)
    roots = simhash.components(edges, "test")
    assert roots.count() == len(prints) - 1 and roots.select("v").distinct().count() == 1


def test_components_of_a_long_path(spark):
    edges = spark.range(400).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    found = simhash.components(edges, "path").collect()
    assert {(r["u"], r["v"]) for r in found} == {(k, 0) for k in range(1, 401)}


def test_edges(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], f"{print_of(r['text']):016x}") for r in edge_docs.collect())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fingerprint"]) for r in rows) == want
    empty = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in empty} == {2} and len(empty) == 3
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert sum(t is None or not t.strip() for t in texts) == 1 and len(texts) == len(set(texts))
    assert simhash.near_duplicates(no_docs).collect() == []
