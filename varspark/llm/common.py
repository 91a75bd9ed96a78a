"""What the operators share: staged tables, and joins with small sides of a checked size."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging

#: A side of a join is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 50_000


@contextmanager
def arrow_rows(spark: SparkSession, batch: int | None) -> Iterator[None]:
    """Rows of an Arrow batch meanwhile (``None``: as they are), where rows are large."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        if batch is not None:
            spark.conf.set(setting, str(batch))
        yield
    finally:
        spark.conf.set(setting, before)


def stage(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage as a checkpoint does, so that a lost executor costs a few tasks and
    not the whole job, and it keeps the columns of the result prunable.  ``batch``: rows of an Arrow batch
    while ``df`` is computed.
    """
    with arrow_rows(df.sparkSession, batch):
        return staging.stage(df, name)


def bucketed(df: DataFrame, name: str, key: str, batch: int | None = None) -> DataFrame:
    """As ``stage``, in buckets of ``key``: grouping by it needs no exchange.  A task writes a file for each of its buckets, so
    ``key`` should have few values in a task."""
    spark = df.sparkSession
    path = staging.scratch(spark, name)
    title = path.rsplit("/", 1)[-1].replace("-", "_")
    with arrow_rows(spark, batch):
        df.write.bucketBy(min(width(spark), 10_000), key).option("path", path).saveAsTable(title)
    found = spark.table(title)
    spark.sql(f"drop table `{title}`")  # the name only: the files stay
    return found


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left", most: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a table that is usually small: it is counted, and broadcast only up to
    ``most`` rows; beyond, an ordinary join (AQE splits skewed keys)."""
    if small.limit(most + 1).count() <= most:
        small = F.broadcast(small)
    return big.join(small, on, how)


def least(df: DataFrame, by: Column, most: int) -> DataFrame:
    """The ``most`` rows with the smallest 64-bit hashes ``by``.  Rows are cut by a threshold first, so that all tasks
    together send little more than that to the driver, however many they are."""
    n, share = df.count(), 1.0
    if n > 2 * most:
        share = 1.5 * most / n
    while share < 1:
        some = df.filter(by <= int(-(2**63) + share * 2**64))
        if some.count() >= most:
            return some.orderBy(by).limit(most)
        share *= 4
    return df.orderBy(by).limit(most)


def width(spark: SparkSession) -> int:
    """Partitions of an exchange: the session's ``spark.sql.shuffle.partitions``."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def release() -> None:
    """Gives freed memory back: workers are kept between tasks, and what they hold counts against their executor."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def tidy(run):
    """A function for mapInArrow that gives freed memory back when its task ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped
