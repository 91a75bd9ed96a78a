from pyspark.sql import DataFrame, SparkSession

from ..ann import nearest
from ..common import table


def op8_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


QUERIES = {"op8_projected_neighbours": op8_projected_neighbours}
ORACLE_SQL: dict[str, str] = {}
