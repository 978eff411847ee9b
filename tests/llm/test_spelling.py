import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from snapweave.llm import queries
from snapweave.llm.spelling import SpellingParams, _cut_numbers, numbered, spelling_groups, spelling_variants

SF = "/root/testdata/sf0.001"
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def vocabulary(rows):
    counts = Counter()
    for i, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


def brute(counts, ratio=10):
    """Rows by wildcard patterns: words meet where one position is starred or left out."""
    near = defaultdict(set)
    meet = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            meet[w[:i], w[i + 1:]].add(w)
    for (a, b), group in meet.items():
        for w in group:
            near[w] |= group - {w}
        if a + b in counts:
            near[a + b] |= group
            for w in group:
                near[w].add(a + b)
    form = {}
    for w, others in near.items():
        best = min(others - {w}, key=lambda o: (-counts[o], o), default=None)
        if best and counts[best] >= ratio * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w] - {w}), counts[form[w]] if w in form else None))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


def test_query_against_brute_force(spark, doc_rows):
    want = brute(vocabulary([(i, t) for i, t, _, _ in doc_rows]))
    assert len(want) > 1000 and sum(w[4] > 0 for w in want) > 100
    assert found(queries.op12_spelling_variants(spark, SF)) == want


@pytest.mark.parametrize("range_words", [7, 100_000])
def test_random_words_over_a_small_alphabet(spark, range_words):
    r = random.Random(3)
    words = {"".join(r.choice("abé") for _ in range(r.randrange(7, 10))): 0 for _ in range(900)}
    counts = {w: int(10 ** r.uniform(0.4, 5)) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute(counts)
    assert any(w[2] not in (w[0], w[1]) for w in want)          # a chain of forms
    assert found(spelling_groups(df, SpellingParams(range_words=range_words))) == want


@pytest.mark.parametrize("range_words", [5, 100_000])
def test_numbers_name_prefixes(spark, range_words, tmp_path):
    """Equal numbers and equal prefixes are the same thing, and ranks follow the order, over any cuts."""
    r = random.Random(5)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randrange(1, 12))) for _ in range(300)})
    spark.createDataFrame([(w, 1) for w in words], "word string, n long").write.parquet(f"{tmp_path}/w")
    rows = numbered(spark.read.parquet(f"{tmp_path}/w"), "word", SpellingParams(range_words=range_words), {"n": "long"}).collect()
    prefix_of = {}
    for row in rows:
        assert len(row["nodes"]) == len(row["word"]) + 1
        for i, node in enumerate(row["nodes"]):
            assert prefix_of.setdefault(node, row["word"][:i]) == row["word"][:i]
    assert len(set(prefix_of.values())) == len(prefix_of)
    assert [x["word"] for x in sorted(rows, key=lambda x: x["rank"])] == words


def test_cut_numbers_share_prefixes():
    named = _cut_numbers(["ab", "abc", "b"])
    assert named[0] == named[1][:3] and named[0][0] == named[2][0] and named[1][3] not in named[0] + named[2]


def test_edges(spark, edge_docs, no_docs):
    assert found(spelling_variants(no_docs)) == []
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert found(spelling_variants(edge_docs)) == brute(vocabulary(rows))


def test_very_long_words_cost_linear_work(spark):
    # doc ids under which the digest leaves the runs whole
    def whole(run):
        return [i for i in range(50) if zlib.crc32(f"{i}:{run}".encode()) % 31][:2]
    long_, longer = "z" * 40_000 + "a" * 40_000, "z" * 40_001 + "a" * 40_000
    rows = [(i, long_) for i in whole(long_)] + [(i, longer) for i in whole(longer)]
    got = found(spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [(len(w), n, near) for w, _, _, n, near, _ in got] == [(80_001, 2, 1), (80_000, 2, 1)] or \
        sorted((len(w), n, near) for w, _, _, n, near, _ in got) == [(80_000, 2, 1), (80_001, 2, 1)]
