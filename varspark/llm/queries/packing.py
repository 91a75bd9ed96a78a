from pyspark.sql import DataFrame, SparkSession

from ..common import table
from ..packing import pack


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES = {"op2_harmonic_packing": op2_harmonic_packing}
ORACLE_SQL: dict[str, str] = {}
