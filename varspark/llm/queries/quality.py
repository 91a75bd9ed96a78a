from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import table
from ..quality import classify, fold

#: A document with a lower score is rejected.
LEAST_SCORE = 0.7


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classify(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted")
    )


QUERIES = {"op5_quality_classifier": op5_quality_classifier}
ORACLE_SQL: dict[str, str] = {}
