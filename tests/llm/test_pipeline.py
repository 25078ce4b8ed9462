"""The pipeline, stage by stage, and the registered queries on the smallest tables."""

import hashlib

import duckdb
import public_tokenizers
import pytest
import tokenizers

import corpus_pipeline
from checks.compare import connect, rows
from registry_spark.llm.queries import ORACLES, QUERIES
from registry_spark.sources.shared import written

SF = "/root/testdata/sf0.001"


def test_names():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF)
    want = connect(SF).execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_every_document(spark, name):
    got = QUERIES[name](spark, SF)
    n = duckdb.sql(f"SELECT count(DISTINCT doc_id), count(*) FROM '{SF}/documents.parquet'").fetchall()[0]
    # Operator 12 returns pieces; every document has a first one.
    got = got.filter("piece = 0") if "piece" in got.columns else got
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert (len(set(ids)), len(ids)) == n


def test_stages(spark, documents, odd_rows):
    docs = documents(odd_rows)
    columns, left = docs.columns, [docs.count()]
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF))
        assert docs.columns == columns, name
        left.append(docs.count())
    assert left[1] == left[0] - 5 and left[2] < left[1] and left[3] <= left[2]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(r["text"])))
    assert sorted(map(str, map(tuple, last.collect()))) == sorted(map(str, want))


def test_empty_documents(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
        assert docs.count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
