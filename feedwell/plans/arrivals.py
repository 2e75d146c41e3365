"""The job over a folder that grows: each file is loaded once, in the order of arrival."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedwell.plans.ingest import Totals, ingest_loaded
from feedwell.plans.spec import FeedSpec
from feedwell.sources.files import latest_files, match_names

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_arrivals(
    spark: SparkSession, directory: str, spec: FeedSpec, current_table: str, history_table: str, rejects_table: str,
    checkpoint: str, files_per_batch: int = 1_000, done: Callable[[int, Totals], None] | None = None,
) -> int:
    """Load the files that no earlier start with this ``checkpoint`` has seen; gives the number of batches.

    Files come oldest first, at most ``files_per_batch`` in a batch; of each feed the newest in a batch is
    loaded, as ``ingest`` does it. Spark's file stream keeps which files were seen, so a start after all
    is done lists the directory and ends. A batch that was cut off is repeated with the same files: it
    replaces the same feeds by the same rows, and the change gate, which sees the records that it wrote,
    lets none of them pass again. ``done`` is told the totals of each batch.
    """
    batches = 0

    def load(files: DataFrame, batch: int) -> None:
        nonlocal batches
        totals = load_batch(files, spec, current_table, history_table, rejects_table)
        batches += 1
        if done is not None:
            done(batch, totals)

    stream = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch).load(directory)
    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return batches


def load_batch(files: DataFrame, spec: FeedSpec, current_table: str, history_table: str, rejects_table: str) -> Totals:
    """Load the newest matching file of each feed among ``files`` (path, modificationTime, length, content)."""
    matching = match_names(files, spec.name_regex)
    chosen = latest_files(matching, None if spec.feed is None else spec.feed_of()).select("path")
    loaded = matching.join(chosen, "path", "left_semi")
    return ingest_loaded(loaded, spec, current_table, history_table, rejects_table)
