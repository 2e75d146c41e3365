"""Staging on the folder that all executors share, and small checks used by several operators."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """A folder for tables that several steps of one job read; dropped at the end of the block.

    It lies under ``spark.checkpoint.dir``, so a lost executor costs no staged row. A result that
    outlives the block goes through ``result``: its folder stays, as the returned table reads it.
    Where the setting is missing, a session of one process (tests, notebooks) gets a temporary folder;
    any other raises.
    """

    def __init__(self, spark: SparkSession):
        context = spark.sparkContext
        root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not root:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="feedwell-"))
            root = context.getCheckpointDir()
        self.spark, self.root = spark, f"{root.rstrip('/')}/llm-{uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/work")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def table(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        """``df`` written once and read back."""
        return self._write(df, f"{self.root}/work/{uuid4().hex}", codec)

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        """As ``table``, but kept after the block."""
        return self._write(df, f"{self.root}/{name}", "zstd")

    def _write(self, df: DataFrame, folder: str, codec: str) -> DataFrame:
        df.write.option("compression", codec).parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)
