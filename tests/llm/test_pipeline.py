import hashlib

import duckdb
import pytest

import corpus_pipeline
from finmart.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_keep_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        after = docs.count()
        assert name.startswith("mixing") or 0 < after <= before
        before = after


def test_run_decodes_to_kept_texts(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    texts = {hashlib.sha256((r.text or "").encode()).hexdigest(): r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert rows and all(r.decoded_sha256 in texts for r in rows)
    assert max(sum(1 for r in rows if r.doc_id == d) for d in {r.doc_id for r in rows}) <= 2


def test_stages_on_odd_documents(spark, odd_documents, no_documents, some_labels, tmp_path):
    some_labels.write.parquet(f"{tmp_path}/labels.parquet")
    clashing = odd_documents.withColumn("number", odd_documents.doc_id).withColumn("_place", odd_documents.doc_id)
    for docs in (clashing, no_documents):
        columns, expected = docs.columns, docs.count() > 0
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == columns
        found = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert all(r.ids_sha256 for r in found) and (expected or not found)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    frame = QUERIES[name](spark, SMALL)
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(cursor.fetchall(), key=str) == sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)
