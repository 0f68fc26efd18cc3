"""The pipeline stage by stage, and the oracles of the SQL-expressible queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF001
from martflow.llm import queries
from test_llm_documents import DOCS, WORD, components, odd, scan  # noqa: F401


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    leak = spark.createDataFrame([(9001, "This is the text of one clean note, password = hunter22 and no more of it.", "en", "src0", 70),
                                  (9002, "1234 ....", "en", "src0", 9), (9003, None, "en", "src0", None)], DOCS)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(leak)
    start = {r.doc_id: r for r in docs.collect()}
    seen = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, seen, SF001)
        assert out.columns == docs.columns, name
        rows = out.collect()
        before = seen.collect()
        if name == "language":
            assert {r.doc_id for r in before} - {r.doc_id for r in rows} == {9002, 9003}
        elif name == "near_duplicates":
            want = components([(r.doc_id, r.text) for r in before], 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted(i for i, (n, c) in want.items() if i == c)
        elif name == "secrets":
            assert {r.doc_id for r in rows} == {r.doc_id for r in before}
            for r in rows:
                spans = scan(start[r.doc_id].text)
                assert (r.text == start[r.doc_id].text) == (not spans)
                if spans:
                    assert not scan(r.text) and r.n_chars == len(r.text)
        elif name == "mix":
            size = {r.doc_id: len(WORD.findall(r.text)) for r in before}
            total = sum(size.values())
            assert abs(sum(size[r.doc_id] for r in rows) - 1.5 * total) < 0.1 * total
        seen = spark.createDataFrame(rows, docs.schema)
    tokens = P.encode(spark, seen, SF001).collect()
    assert len(tokens) == seen.count() and all(r.exact for r in tokens)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF001)
    want = sorted((r.doc_id, r.n_tokens) for r in docs.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in P.run(spark, SF001).collect()) == want


def test_stages_on_odd_and_empty_inputs(spark, odd):  # noqa: F811
    for docs in (odd, odd.limit(0)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF001)
            assert name == "encode" or out.columns == docs.columns
            out.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF001).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist()), key=str) == sorted(map(tuple, want.values.tolist()), key=str)
