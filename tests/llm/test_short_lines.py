"""Line dedup without a floor: the query and the pipeline's stage, on lines of every length."""

import random

import corpus_pipeline
from snapweave.llm import line_dedup, queries
from tests.llm import test_line_dedup

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_short_lines_against_brute_force(spark, tmp_path):
    r = random.Random(5)
    docs = [(i, "\n".join("".join(r.choice("ab é") for _ in range(r.randrange(9))) for _ in range(r.randrange(6))),
             "en", "s", 1) for i in range(200)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    edits = line_dedup.line_report(spark.createDataFrame(docs, DOCS), min_chars=1, edit_chars=1)
    assert test_line_dedup.found(edits) == test_line_dedup.brute([d[:2] for d in docs], min_chars=1, edit_chars=1)
    want = test_line_dedup.brute([d[:2] for d in docs], min_chars=1)
    assert want and test_line_dedup.found(queries.op1_line_dedup(spark, str(tmp_path))) == want


def test_query_on_the_whole_table(spark, doc_rows):
    rows = [(i, t) for i, t, _, _ in doc_rows]
    assert test_line_dedup.found(queries.op1_line_dedup(spark, SF)) == test_line_dedup.brute(rows, min_chars=1)


def test_a_copy_with_a_short_line_goes_whole(spark):
    text = "Contents\n" + "one long line of this text, well above any floor\n" + "The end"
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, "Contents\nof its own", "en", "s", 1)], DOCS)
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup_stage(spark, docs, SF).collect()}
    assert out == {1: text, 3: "of its own"}
