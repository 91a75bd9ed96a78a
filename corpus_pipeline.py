"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspark.llm import jaccard, linededup, mixing, packing, quality
from varspark.llm.common import join_small, stage, table
from varspark.llm.queries.quality import LEAST_SCORE

#: The classifier and the random draws cannot be written in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    whole = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")  # whatever else its columns are named
    scored = quality.classify(whole, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") >= LEAST_SCORE).select("__row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; n_chars follows the text."""
    whole = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")
    kept = linededup.apply_bitmaps(whole, stage(linededup.keep_bitmaps(whole), "line-bitmaps"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns))


def similar_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays."""
    groups = jaccard.similar_documents(docs)
    gone = stage(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "similar-gone")
    return join_small(docs, gone, "doc_id", "left_anti", 500_000).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs, stage(mixing.mix(docs), "mix-plan"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 ids."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("similar", similar_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
