from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import table
from ..fertility import fertility_rules


def op11_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = fertility_rules(docs, keep=["doc_id"])
    return found.select(
        "kept.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("kept_by_rules").alias("kept"),
        F.array_join("broken", ",").alias("broken"), "fertility_0", "fallback_0", "entropy_0", "fertility_1", "fallback_1", "entropy_1",
    )


QUERIES = {"op11_tokeniser_fertility": op11_tokeniser_fertility}
ORACLE_SQL: dict[str, str] = {}
