"""The stages one after another, each judged on its own input."""

import corpus_pipeline
import __spark_entry__ as contract
from tests.conftest import TESTDATA
from tests.llm.tables import odd_documents, with_clashes
from terratally.llm.queries import QUERIES, SQL


def test_queries_are_registered():
    names = set(contract.queries())
    assert set(QUERIES) <= names and "pipeline" in names and set(SQL) <= set(QUERIES)
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").where("doc_id < 300")
    before = None
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, TESTDATA).write.parquet(path)
        done = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert done.columns == list(corpus_pipeline.COLUMNS), name
            kept = {r["doc_id"] for r in done.select("doc_id").collect()}
            assert kept <= {r["doc_id"] for r in docs.select("doc_id").collect()}, name
        before, docs = docs, done
    pieces = docs.collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in before.select("doc_id").collect()}


def test_odd_documents_pass_through(spark):
    docs = with_clashes(odd_documents(spark))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, TESTDATA).columns == list(corpus_pipeline.COLUMNS), name
