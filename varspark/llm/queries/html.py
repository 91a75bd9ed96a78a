from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import table
from ..html import main_text, train


def op4_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = main_text(pages, train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op4_block_labeller": op4_block_labeller}
ORACLE_SQL: dict[str, str] = {}
