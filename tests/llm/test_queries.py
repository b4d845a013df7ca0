"""The registered queries on the smallest tables, and the pipeline's stages."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tsnorm.llm.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, str(SF)).toPandas(), con.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert got.equals(want.astype(got.dtypes))


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op1_language_id"](spark, str(SF)).filter("held_out").join(docs, "doc_id")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count() > 0


def test_pipeline_stages_filter_and_pack(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, str(SF)).cache()
        assert after.columns == docs.columns and 0 < after.count() <= before.count(), name
        before = after
    clean = docs.join(before, "doc_id", "left_anti").count()
    assert 0 < clean < 0.3 * docs.count()
    pieces = corpus_pipeline.run(spark, str(SF))
    assert pieces.select("doc_id").distinct().count() == before.count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
