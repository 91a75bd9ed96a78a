from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import table
from ..gif import gif_frames, text_to_gif


def op3_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = text_to_gif(table(spark, sf_dir, "documents"))
    payload = F.aggregate("frames", F.lit(b""), lambda a, f: F.concat(a, f["samples"]))
    total = F.aggregate(
        "frames",
        F.array_repeat(F.lit(0), 64),
        lambda a, f: F.zip_with(a, f["histogram"], lambda x, y: x + y),
    )
    read = gif_frames(stored).withColumn("payload", payload)
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16, 16)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.array_join(total.cast("array<string>"), ",").alias("feature"),
        F.size("frames").cast("long").alias("n_frames"),
    )


QUERIES = {"op3_gif_media": op3_gif_media}
ORACLE_SQL: dict[str, str] = {}
