import re
from collections import Counter

from snapweave.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes):
    """Targets by resharing until none is above its top."""
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    out, left, budget = {}, set(sizes), 1.5 * sum(sizes.values())
    while left:
        share = budget / sum(weight[s] for s in left)
        full = {s for s in left if share * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: share * weight[s] for s in left}
        out |= {s: 2.0 * sizes[s] for s in full}
        budget -= sum(2.0 * sizes[s] for s in full)
        left -= full
    return out


def check(docs, params=mixing.MixingParams()):
    rows = mixing.mixture(docs, params).collect()
    texts = docs.select("doc_id", "source", "text").collect()
    sizes = Counter()
    for r in texts:
        sizes[r["source"]] += size(r["text"])
    want = filled(sizes)
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"]) for r in rows) == sorted(
        (str(r["doc_id"]), size(r["text"]), sizes[r["source"]]) for r in texts)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert sorted(round(t, 6) for t in {r["target"] for r in rows}) == sorted({round(t, 6) for t in want.values()})
    assert sorted(tuple(map(str, r)) for r in rows) == sorted(tuple(map(str, r)) for r in mixing.mixture(docs, params).collect())
    return rows, want


def test_whole_table(documents, doc_rows):
    rows, want = check(documents)
    source = {i: s for i, _, _, s in doc_rows}
    taken = Counter()
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
    # nothing left out or taken would come nearer by more than half of the smallest document left
    off = {s: abs(want[s] - taken[s]) for s in want}
    largest = Counter()
    for _, t, _, s in doc_rows:
        largest[s] = max(largest[s], size(t))
    assert all(off[s] <= largest[s] / 2 for s in want)
    assert sum(off.values()) <= 0.02 * sum(want.values())


def test_shards_are_even_and_hold_every_copy(documents):
    p = mixing.MixingParams(shard_words=5000, unit_words=10, blocks=16)
    rows, _ = check(documents, p)
    held = Counter(s for r in rows for s in r["shards"].split(",") if s)
    mixed = mixing.mix(documents, p)
    assert len(held) > 8 and max(held.values()) < 4 * min(held.values())
    assert Counter(str(r["shard"]) for r in mixed.collect()) == held
    assert [r["doc_id"] for r in mixed.collect()] == [r["doc_id"] for r in mixing.mix(documents, p).collect()]


def test_tree_splits_exactly(spark):
    quotas = spark.createDataFrame([(0, 100), (1, 7), (2, 0), (3, 33)], "rank int, n int")
    rows = mixing.split_tree(quotas, 8, 5).collect()
    total = Counter()
    for r in rows:
        total[r["rank"]] += r["n"]
    assert dict(total) == {0: 100, 1: 7, 2: 0, 3: 33}
    shards = Counter()
    for r in rows:
        shards[r["shard"]] += r["n"]
    assert set(shards.values()) <= {17, 18}


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == [*edge_docs.columns, "mix_shard"]
    assert mixing.mixture(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []
