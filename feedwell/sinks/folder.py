"""A place on shared storage for results that several later steps read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, or the context's checkpoint folder; executors must share it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/feedwell-{uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a table once and reads it back, so that later steps do not compute it again.

    The copies survive the loss of executors; all are dropped at the end.
    """
    folder = shared_folder(spark)
    try:
        yield lambda df: _written(df, f"{folder}/{uuid4().hex}")
    finally:
        drop_folder(spark, folder)


def _written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
