"""Annotation of files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import trim_key
from ..operators.mapping import lookup_worklist
from ..plans.pipeline import pipeline


def _files(spark: SparkSession, source: str, schema: str, fmt: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).load(source)


def annotate_stream(spark: SparkSession, source: str, schema: str, sink: str, stages: list[Callable[[DataFrame], DataFrame]], checkpoint: str, fmt: str = "parquet", max_files: int | None = None):
    """Each new file of ``source`` goes through ``stages`` (joins with static tables) and is appended to ``sink``; a batch has
    at most ``max_files`` of them.

    Stateless: a row's slots arrive together, so lists are packed within the batch.  A restart
    goes on after the last batch that ended; a batch that is run again replaces its own folder.
    """

    def batch(df: DataFrame, number: int) -> None:
        pipeline(df, stages).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = _files(spark, source, schema, fmt, max_files)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def worklist_stream(spark: SparkSession, source: str, schema: str, cache: Callable[[], DataFrame], now, sink: str, checkpoint: str, fmt: str = "parquet", max_files: int | None = None, again: str = "1 day"):
    """The keys of each batch that the cache does not hold at that time and that did not arrive before.

    Keys that arrived are kept in the stream's state until ``again`` has passed since their arrival, then a key may be asked for once more (a
    miss holds for a day in the cache).  So a batch looks up its own keys, however many came before, and a batch that is run
    again meets the state as it was and replaces its own folder."""

    def batch(df: DataFrame, number: int) -> None:
        lookup_worklist(df.select("key"), cache(), now).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = _files(spark, source, schema, fmt, max_files)
    keys = stream.select(trim_key(F.col("key")).alias("key"), F.current_timestamp().alias("_arrived")).filter("key <> ''")
    fresh = keys.withWatermark("_arrived", again).dropDuplicatesWithinWatermark(["key"])
    return fresh.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
