import random
import re

from snapweave.llm import line_dedup


def rest(line, size, at):
    tail = size - at - 1
    return size, at, line[:at], line[len(line) - tail:] if tail else ""


def brute(docs, min_chars=20, edit_chars=20):
    """Dropped (id, line number) by comparing every line with every variant of every other that is long enough."""
    places = {}
    for i, text in docs:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(line) >= min_chars and re.search(r"[^\x20\x09-\x0D]", line):
                places.setdefault(line, []).append((i is None, i or 0, n))
    first = {}
    for line, at in places.items():
        for size in (len(line), len(line) + 1) if len(line) >= edit_chars else ():
            for p in range(size):
                key = rest(line, size, p)
                first[key] = min(first.get(key, min(at)), min(at))
    out = set()
    for line, at in places.items():
        sizes = (len(line), len(line) + 1) if len(line) >= edit_chars else ()
        low = min([*at, *(first[rest(line, size, p)] for size in sizes for p in range(size))])
        out |= {(None if a[0] else a[1], a[2]) for a in at if a > low}
    return out


def found(report):
    return {(r["doc_id"], int(n)) for r in report.collect() for n in r["dropped"].split(",") if n}


def test_random_edits(spark):
    r = random.Random(11)
    base = ["".join(r.choice("abcdeé ") for _ in range(r.choice([20, 21, 22, 33, 40, 70, 300, 1000]))) for _ in range(50)]

    def edit(s):
        p, k = r.randrange(len(s)), r.randrange(4)
        return [s, s[:p] + "x" + s[p + 1:], s[:p] + s[p + 1:], s[:p] + "y" + s[p:]][k]

    docs = [(i, "\n".join(edit(edit(r.choice(base)) if r.random() < 0.5 else r.choice(base)) for _ in range(r.randrange(8))))
            for i in range(120)] + [(None, base[0]), (900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert want and found(line_dedup.line_report(df)) == want


def test_whole_table(documents, doc_rows):
    short = [(i, t) for i, t, _, _ in doc_rows if max(map(len, t.split("\n"))) < 3000]
    df = documents.where(documents.doc_id.isin([i for i, _ in short]))
    assert found(line_dedup.line_report(df)) == brute(short)


def test_edges(spark, edge_docs, no_docs):
    rows = line_dedup.line_report(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {(r["doc_id"], r["n_lines"]): r["dropped"] for r in rows}
    assert by_id[(1, 2)] == "1"               # both repeated rows keep line 0
    assert by_id[(2, 0)] == "" and by_id[(5, 2)] == ""
    clean = line_dedup.dedup_lines(edge_docs)
    assert clean.columns == edge_docs.columns
    texts = [r["text"] for r in clean.collect()]
    assert texts.count("a line of twenty and more characters") == 2
    assert "a line of twenty and more characters!" not in texts   # null id comes last, one edit away
    assert line_dedup.line_report(no_docs).collect() == []


def test_one_edit_in_a_very_long_line(spark):
    line = "".join(chr(97 + (i * i) % 23) for i in range(40_000))
    docs = [(1, line), (2, line[:20_000] + "#" + line[20_000:]), (3, line[:5] + line[6:]), (4, line[:-1] + "##")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(line_dedup.line_report(df)) == {(2, 0), (3, 0)}


def test_edits_count_from_a_length_on(spark):
    docs = [(1, "a\nb\n7\nab\nIt.\nIst.\na"), (2, "b\nnineteen characters\nnineteen charakters"), (3, "twenty characters ok\ntwenty charakters ok")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(line_dedup.line_report(df, 1)) == {(1, 6), (2, 0), (3, 1)} == brute(docs, 1)
    assert found(line_dedup.line_report(df, 1, edit_chars=1)) == brute(docs, 1, 1) > {(1, 1), (1, 5), (2, 2)}


def test_texts_without_an_id_are_told_apart(spark):
    docs = [(None, "one line of twenty characters and more\nfirst"), (None, "one line of twenty characters and more\nsecond")]
    report = line_dedup.line_report(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r["n_dropped"] for r in report.collect()) == [0, 1]


def test_long_runs_of_one_character_cost_their_length(spark):
    size = 1_000_000
    docs = [(1, "a" * size), (2, "a" * (size + 1)), (3, "a" * 600_000 + "b" + "a" * (size - 600_001)), (4, "a" * (size + 3))]
    assert found(line_dedup.line_report(spark.createDataFrame(docs, "doc_id long, text string"))) == {(2, 0), (3, 0)}
