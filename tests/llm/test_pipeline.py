"""The pipeline's stages: each on its own input, against brute force, and the queries against their SQL."""

import numbers
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_operators import brute_components, brute_lines

import corpus_pipeline
from varspark.llm.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"


def test_stages(spark, docs, local):
    by = dict(corpus_pipeline.STAGES)
    assert list(by) == ["quality", "lines", "similar", "mixing", "packing"]
    kept = by["quality"](spark, docs, "/root/testdata/sf0.01")
    assert kept.columns == docs.columns
    lines = by["lines"](spark, docs, DATA)
    assert lines.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in lines.collect()), key=str) == sorted(((i, t) for i, _, _, t in brute_lines(local)), key=str)
    assert lines.filter("n_chars <> length(text)").count() == 0
    similar = by["similar"](spark, docs, DATA)
    gone = {i for i, _, c in brute_components(local) if i != c}
    assert Counter(r.doc_id for r in similar.collect()) == Counter(r["doc_id"] for r in local if r["doc_id"] not in gone)
    mixed = by["mixing"](spark, docs, DATA)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert by["packing"](spark, docs, DATA).count() >= len(local)
    for f in by.values():
        assert f(spark, docs.limit(0), DATA).count() == 0


def test_quality_stage_keeps_clean_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1")
    kept = corpus_pipeline.quality_stage(spark, d, "/root/testdata/sf0.01").join(labels, "doc_id").count()
    assert kept >= 0.98 * labels.count()


def _text(v):
    # pandas holds integers with nulls as floats
    return "<null>" if pd.isna(v) else repr(float(v)) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = c.sql(oracle_sql()[name]).df()
    got = queries()[name](spark, DATA).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = lambda d: sorted(tuple(map(_text, r)) for r in d[cols].itertuples(index=False))
    assert key(got) == key(want)


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
