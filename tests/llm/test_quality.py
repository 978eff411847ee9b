import collections
import math
import random
import re

from snapweave.llm import quality


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    seen = collections.Counter(tuple(words[i:i + 8]) for i in range(n - 7))
    hit = {k for i in range(n - 7) if seen[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = n < 20 or 100 * len(hit) > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed)


def got(r):
    return (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])


def test_base_counts_match_brute_force(documents, doc_rows):
    found = {r["doc_id"]: got(r) for r in quality.judge(documents).collect()}
    assert found == {i: base(t) for i, t, _, _ in doc_rows}


def test_edges(edge_docs, no_docs):
    want = sorted((r["doc_id"] or -1, *base(r["text"])) for r in edge_docs.collect())
    assert sorted((r["doc_id"] or -1, *got(r)) for r in quality.judge(edge_docs).collect()) == want
    assert quality.judge(no_docs).collect() == []
    assert quality.filter_quality(no_docs).collect() == []
    assert quality.filter_quality(edge_docs).columns == edge_docs.columns


def test_window_that_is_no_power_of_two(spark):
    from pyspark.sql import functions as F
    words = "a b c d e f x a b c d e f y b c d e f x q a b c d e".split()
    df = spark.createDataFrame([(words,)], "words array<string>")
    for window in (1, 3, 5, 6, 7):
        at = range(len(words) - window + 1)
        seen = collections.Counter(tuple(words[i:i + window]) for i in at)
        want = {k for i in at if seen[tuple(words[i:i + window])] > 1 for k in range(i, i + window)}
        assert df.select(quality.repeated_words(F.col("words"), window)).first()[0] == len(want)


def test_distance_is_jensen_shannon(spark):
    from pyspark.sql import functions as F
    p, q = [0.5, 0.0, 0.3, 0.2], [0.1, 0.4, 0.5, 0.0]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    shares = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(x).alias("p")) for k, x in enumerate(p) if x > 0])
    found = spark.range(1).select(quality.js_distance(shares, q)).first()[0]
    assert abs(found - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-9


def test_odd_documents_go_and_clean_ones_stay(spark, documents):
    odd = spark.createDataFrame([(10**9, " ".join(f"{'%$#'[i % 3]}{i}{'&*'[i % 2]}" for i in range(200)), "en", "s", 1)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in quality.filter_quality(documents.select(odd.columns).union(odd)).select("doc_id").collect()}
    assert 10**9 not in kept
    judged = quality.judge(documents).collect()
    sound = [r for r in judged if not r["base_failed"]]
    assert sum(r["kept"] for r in sound) > 0.85 * len(sound)


def _gibberish(r, n):
    return " ".join("".join(r.choice("etaoinshrdlucmfwypvbgk") for _ in range(r.randrange(2, 9))) for _ in range(n))


def test_word_check_alone_finds_gibberish_and_tables(spark, documents):
    r = random.Random(3)
    texts = [_gibberish(r, n) for n in (190, 190, 5000)] + [" | ".join(_gibberish(r, 150).split())]
    odd = spark.createDataFrame([(10**9 + i, t, None, "s", 1) for i, t in enumerate(texts)],     # in no reference
                                "doc_id long, text string, lang string, source string, n_chars long")
    both = documents.select(odd.columns).union(odd)
    # the character check is off: its distance is at most one
    judged = quality.judge(both, quality.QualityParams(max_char_distance=1.0)).collect()
    assert [x["kept"] for x in judged if x["doc_id"] >= 10**9] == [False] * len(texts)


def test_full_verdict_matches_plain_python(spark, documents):
    import numpy as np
    p = quality.QualityParams()
    rows = [(x["doc_id"], x["text"] or "", x["lang"]) for x in documents.select("doc_id", "text", "lang").collect()]
    top = {}
    for _, t, lang in rows:
        if lang is not None:
            top.setdefault(lang, collections.Counter()).update(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t) if len(w) <= 5)
    words = sorted({w for c in top.values() for w, _ in sorted(c.items(), key=lambda e: (-e[1], e[0]))[:p.common_words]})

    def hists(t):
        found = collections.Counter(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t) if len(w) <= 5)
        common = [found[w] for w in words]
        spaces = len(re.findall(r"[\x20\x09-\x0D]", t))
        classes = [sum(c in "aeiou" for c in t), sum(c.isupper() for c in t), sum(c in "0123456789" for c in t),
                   sum(c in "#*$%&|<>" for c in t), sum(c in ".,;:!?'\"()-" for c in t), sum(ord(c) > 127 for c in t), spaces]
        return np.array([*classes, max(len(t) - sum(classes), 0)], float), np.array([*common, base(t)[0] - sum(common)], float)

    share = lambda x: x / max(x.sum(), 1)
    term = lambda x: sum(v * math.log2(v) for v in x if v > 0)
    js = lambda a, b: math.sqrt(max((term(a) + term(b)) / 2 - term((a + b) / 2), 0))
    feats = {i: (*hists(t), base(t)) for i, t, _ in rows}
    refs = {}
    for i, _, lang in rows:
        if lang is not None and not feats[i][2][5]:
            c, w = refs.get(lang, (0, 0))
            refs[lang] = (c + feats[i][0], w + feats[i][1])
    best = {i: min((js(share(c), share(rc)) + js(share(w), share(rw)), js(share(c), share(rc)), js(share(w), share(rw)))
                   for rc, rw in refs.values()) for i, (c, w, _) in feats.items()}
    sizes = {}
    for i, (_, _, b) in feats.items():
        if not b[5] and b[0] >= p.guard_words:
            sizes.setdefault(b[0].bit_length() - 1, []).append(math.floor(best[i][2] * 1000) / 1000)
    limits, limit = {}, 1.0
    for size in sorted(sizes):
        d = sorted(sizes[size])
        low, high = d[math.ceil(len(d) / 4) - 1], d[math.ceil(3 * len(d) / 4) - 1]
        limit = limits[size] = min(limit, max(high + p.fence * (high - low), p.min_word_limit))
    want = {i: not b[5] and not (b[0] >= p.guard_words and (best[i][1] > p.max_char_distance or best[i][2] > limits[b[0].bit_length() - 1]))
            for i, (_, _, b) in feats.items()}
    assert {x["doc_id"]: x["kept"] for x in quality.judge(documents).collect()} == want
