from pyspark.sql import DataFrame, SparkSession

from ..common import table
from ..mixing import mix


def op1_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "expected", "copies")


QUERIES = {"op1_pareto_mixing": op1_pareto_mixing}
ORACLE_SQL: dict[str, str] = {}
