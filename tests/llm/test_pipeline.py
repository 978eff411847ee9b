import corpus_pipeline
from snapweave.llm import queries
from tests.llm import test_line_dedup, test_simhash
from tests.llm.test_mixing import size

SF = "/root/testdata/sf0.001"


def test_each_stage_against_a_plain_version(spark):
    """Every stage on its own input, by brute force where the stage has one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == columns and 0.7 * docs.count() < kept.count() < docs.count()

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    gone = test_line_dedup.brute(rows, min_chars=1)
    want = {}
    for i, text in rows:
        lines = text.split("\n")
        left = "\n".join(x for n, x in enumerate(lines) if (i, n) not in gone)
        if left.strip() or len(left) == len(text):
            want[i] = left
    cut = corpus_pipeline.line_dedup_stage(spark, kept, SF)
    assert cut.columns == columns and {r["doc_id"]: r["text"] for r in cut.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    one = corpus_pipeline.simhash_near_dedup(spark, cut, SF)
    prints = [(i, test_simhash.print_of(t)) for i, t in want.items()]
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == set(test_simhash.groups(prints))

    clean = corpus_pipeline.benchmark_decontamination(spark, one, SF)
    assert clean.columns == columns and 0.95 * one.count() < clean.count() <= one.count()
    mixed = corpus_pipeline.mixing_to_targets(spark, clean, SF)
    words = sum(size(r["text"]) for r in clean.collect())
    assert abs(sum(size(r["text"]) for r in mixed.collect()) - 1.5 * words) < 0.05 * words


def test_run_and_reruns_agree(spark):
    key = lambda rows: sorted((r["doc_id"], r["shard"], r["text"]) for r in rows)
    first = key(corpus_pipeline.run(spark, SF).collect())
    assert first and first == key(corpus_pipeline.run(spark, SF).collect())


def test_edge_tables_pass_every_stage(spark, edge_docs, no_docs, tmp_path):
    for number, start in enumerate((edge_docs, no_docs)):
        docs = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert out.columns[:len(start.columns)] == start.columns
            out.write.parquet(f"{tmp_path}/{number}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{number}-{k}")


def test_every_query_is_registered():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {*queries.QUERIES, "pipeline"} <= names and len(queries.QUERIES) == 13
    assert set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


def test_oracles(spark):
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, SF)
        want = con.execute(sql).to_arrow_table().to_pylist()
        flat = lambda rows: sorted(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)
        assert flat(r.asDict() for r in got.collect()) == flat(want), name
