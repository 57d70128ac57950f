"""Registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from gleanery.llm.queries import ORACLES, QUERIES
from gleanery.session import stored

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "benchmark"):
        engine.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = engine.sql(ORACLES[name]).fetchdf()
    got = QUERIES[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got[want.columns].values.tolist())) == sorted(map(tuple, want.values.tolist()))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    repeated = stored(docs.union(docs.where("doc_id < 5")).withColumn("place", docs.doc_id))
    before = {r.doc_id: r.text for r in docs.collect()}
    ids = set(before)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, repeated if name == "quality" else out, SMALL))  # noqa: F821
        assert out.columns == corpus_pipeline.COLUMNS
        rows = out.collect()
        assert {r.doc_id for r in rows} <= ids
        ids = {r.doc_id for r in rows}
        if name in ("exact", "near"):
            assert len(rows) == len(ids)
        if name == "passages":
            assert all(r.text == before[r.doc_id] or len(r.text) == r.n_chars < len(before[r.doc_id]) for r in rows)
    packed = corpus_pipeline.packing(spark, out, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids
    assert len(ids) > 150


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL))
        assert docs.count() == 0
