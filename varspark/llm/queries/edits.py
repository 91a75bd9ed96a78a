from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import table
from ..edits import apply_edits, token_trees


def _edit(at, delete, insert):
    return F.struct(at.cast("long").alias("at"), F.lit(delete).cast("long").alias("delete"), F.lit(insert).alias("insert"))


def op7_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document gets three edits: in its middle, at three quarters and at its start."""
    n = F.coalesce(F.length("text"), F.lit(0))
    edits = F.array(_edit(n / 2, 7, ""), _edit(n * 3 / 4, 3, " it's 42"), _edit(F.lit(0), 0, "Note: "))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    before = token_trees(docs).withColumn("n_tokens_before", F.col("n_tokens"))
    return apply_edits(before).select("doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), "n_edits", "reencoded_chars", F.length("text").cast("long").alias("n_chars_after"))


QUERIES = {"op7_edit_aware_counts": op7_edit_aware_counts}
ORACLE_SQL: dict[str, str] = {}
