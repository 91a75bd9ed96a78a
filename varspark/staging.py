"""Tables staged in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where it is not set a temporary folder is made, but only if everything runs on one machine."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="varspark-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; ``clear_staged`` deletes it."""
    path = f"{shared_dir(spark)}/varspark/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later evaluations all see the same rows, and a
    lost executor costs a few tasks."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> int:
    """Deletes what this process has staged so far; frames that still read it are lost."""
    jvm = spark.sparkContext._jvm
    n = len(_staged)
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n
