"""The current table and the history table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwell.sinks.commits import Decide, append_decided
from feedwell.sinks.folder import drop_folder, shared_folder

HISTORY_SCHEMA = (
    "feed string, filename string, processing_timestamp string, flagged_line_count bigint, "
    "recorded_at timestamp"
)


def write_current(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace the table's rows and schema. ``path`` makes it an external table."""
    writer = df.write.mode("overwrite")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def replace_feeds(kept: DataFrame, table: str, loaded: DataFrame) -> None:
    """Replace the rows of the loaded feeds (``loaded`` has a column ``feed``) by ``kept``; other feeds stay.

    The table is partitioned by feed, and only partitions with new rows are overwritten: files of other
    feeds are not touched, and a write that fails part way leaves all old rows. Feeds that are left
    without rows lose their partition. A feed of no name is NULL in the table, as in any partition.

    A table of other columns, or without partitions, is written anew with the rows that stay, from a
    copy on shared storage; if that fails, the copy stays and the error names it.
    """
    spark = kept.sparkSession
    kept = kept.select(*[c for c in kept.columns if c != "feed"], "feed")
    if not spark.catalog.tableExists(table):
        return kept.write.partitionBy("feed").saveAsTable(table)
    spark.catalog.refreshTable(table)
    columns = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)]
    if columns != [(f.name, f.dataType.simpleString(), f.name == "feed") for f in kept.schema]:
        return _rebuild(kept, table, loaded)
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        kept.write.insertInto(table, overwrite=True)
    empty = loaded.select(_named("feed")).join(kept.select(_named("feed")), "__feed", "left_anti")
    _drop_feeds(spark, table, (r[0] for r in empty.distinct().toLocalIterator()))


def _named(feed: str):
    """The feed as its partition is named; never NULL, so that it can be joined."""
    return F.coalesce(F.col(feed), F.lit("")).alias("__feed")


def _drop_feeds(spark: SparkSession, table: str, feeds: Iterable[str], at_once: int = 500) -> None:
    held: list[str] = []
    for feed in [*feeds, None]:
        if held and (feed is None or len(held) == at_once):
            spark.sql(f"alter table {table} drop if exists {', '.join(held)}")
            held = []
        if feed is not None:
            text = feed.replace("\\", "\\\\").replace("'", "\\'")
            held.append(f"partition (feed = '{text}')" if feed else "partition (feed = null)")


def _rebuild(kept: DataFrame, table: str, loaded: DataFrame) -> None:
    spark = kept.sparkSession
    old = spark.table(table)
    if "feed" in old.columns:
        gone = loaded.select(_named("feed")).distinct()
        stay = old.withColumns({"__feed": F.coalesce("feed", F.lit(""))}).join(gone, "__feed", "left_anti")
        kept = kept.unionByName(stay.select([c for c in old.columns if c in kept.columns]), allowMissingColumns=True)
    folder = shared_folder(spark)
    kept.write.parquet(folder)
    try:
        copy = spark.read.schema(kept.schema).parquet(folder)
        copy.write.mode("overwrite").partitionBy("feed").saveAsTable(table)
    except Exception as problem:
        problem.add_note(f"all rows of {table} are in {folder}")
        raise
    drop_folder(spark, folder)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def append_history(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append rows, creating the table the first time. An empty frame writes nothing to a table that is there.

    Rows that were chosen by what the table holds go through ``append_changes``.
    """
    if df.sparkSession.catalog.tableExists(table) and df.isEmpty():
        df.limit(0).unionByName(df.sparkSession.table(table).limit(0))  # raises on other columns
        return
    writer = df.write.mode("append")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def append_changes(spark: SparkSession, table: str, decide: Decide, schema: str = HISTORY_SCHEMA) -> bool:
    """Append what ``decide`` gives for the history, creating it the first time; once, however many runs there are."""
    if not spark.catalog.tableExists(table):
        _no_rows(spark, schema).write.mode("ignore").saveAsTable(table)
    return append_decided(spark, table, decide)


def read_history(spark: SparkSession, table: str, schema: str = HISTORY_SCHEMA) -> DataFrame:
    """The history table, or no rows when it does not exist yet. Other errors propagate."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return _no_rows(spark, schema)


def _no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table; made from a list, it would start Python workers of its own on the executors.

    Its columns are no constants: of those the optimizer would make joins without keys.
    """
    return spark.range(0).select(F.from_json(F.col("id").cast("string"), schema).alias("row")).select("row.*")


def with_feed_and_time(history: DataFrame) -> DataFrame:
    """History with ``feed`` and ``recorded_at``, which a three-column log of one feed lacks.

    Such a log is one unnamed feed, and its order is known to the minute.
    """
    added = {
        "feed": F.lit(""),
        "recorded_at": F.to_timestamp("processing_timestamp", "yyyy-MM-dd HH:mm"),
    }
    return history.withColumns({n: c for n, c in added.items() if n not in history.columns})
