"""The whole job: newest files in, current table replaced, history appended on change."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedwell.operators.history import change_gate, history_record
from feedwell.plans.load import feed_counts, kept_rows, rejects, sheet_rows
from feedwell.plans.spec import FeedSpec
from feedwell.sinks.folder import shared_folder, staging
from feedwell.sinks.tables import append_changes, read_history, replace_feeds, with_feed_and_time, write_current
from feedwell.sources.files import count_files, latest_files, listing, open_directory, read_file, read_files

HISTORY_ORDER = ("recorded_at", "processing_timestamp")


@dataclass(frozen=True)
class Totals:
    """What one run did."""

    workbooks: int = 0
    rejected: int = 0
    rows_read: int = 0
    rows_kept: int = 0
    flagged: int = 0
    candidates: int = 0
    """Files whose name matched; 0 where workbooks were given and not looked for."""


def ingest(
    spark: SparkSession, directory: str, spec: FeedSpec, current_table: str, history_table: str,
    rejects_table: str | None = None, recorded_at: datetime | None = None,
) -> Totals:
    """Load the newest matching file of each feed in ``directory``.

    Without a matching file nothing is touched. See ``ingest_loaded``.
    """
    opened = open_directory(spark, directory)
    files = listing(opened, spec.name_regex)
    candidates = count_files(files).first().files
    if not candidates:
        return Totals()
    chosen = latest_files(files, None if spec.feed is None else spec.feed_of())
    loaded = read_files(opened, chosen)
    done = ingest_loaded(loaded, spec, current_table, history_table, rejects_table, recorded_at)
    return replace(done, candidates=candidates)


def ingest_file(
    spark: SparkSession, path: str, spec: FeedSpec, current_table: str, history_table: str,
    rejects_table: str | None = None, recorded_at: datetime | None = None,
) -> Totals:
    """Load one file by its path, whatever its name."""
    loaded = read_file(spark, path)
    return ingest_loaded(loaded, spec, current_table, history_table, rejects_table, recorded_at)


def ingest_loaded(
    loaded: DataFrame, spec: FeedSpec, current_table: str, history_table: str,
    rejects_table: str | None = None, recorded_at: datetime | None = None,
) -> Totals:
    """Load workbooks given as (path, content), one per feed.

    A workbook that is damaged, has no matching sheet or lacks a required
    column raises ``ValueError`` before any table changes; several are listed in a folder that the
    error names. With ``rejects_table`` they are listed there instead and the others are loaded; if
    there are no others, the current table and the history stay as they are.

    Only rows of the loaded feeds are replaced in the current table: feeds that were rejected, or are
    not in this run, keep theirs. Several runs at once append each change to the history once.

    ``recorded_at`` without a zone is in the session's time zone; default is now.

    Parsing is by far the dearest step, so it is done once: its rows are staged
    on shared storage, and the tables, counts and history come from the copy.
    """
    spark = loaded.sparkSession
    history = read_history(spark, history_table)
    if spec.feed is not None and "feed" not in history.columns:
        raise ValueError(f"{history_table} has no feed column, so it can hold one unnamed feed only")
    with staging(spark) as stage:
        # Counts are observed as the copies are written, which takes no pass of its own.
        seen, listed, summed = Observation(), Observation(), Observation()
        refused = F.count_if(F.col("reason").isNotNull()).alias("rows")
        rows = stage(sheet_rows(loaded.withColumn("feed", spec.feed_of()), spec, stage).observe(seen, refused))
        bad, rejected = rejects(rows), 0
        if rejects_table is not None:
            write_current(bad.observe(listed, F.count(F.lit(1)).alias("rejected")), rejects_table)
            rejected = listed.get["rejected"]
        elif seen.get["rows"]:
            raise ValueError(_refused(bad, bad.count()))

        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_read", "rows_kept", "flagged")]
        counts = stage(feed_counts(rows, spec).observe(summed, F.count(F.lit(1)).alias("workbooks"), *sums))
        totals = Totals(rejected=rejected, **summed.get)
        if totals.workbooks:
            replace_feeds(kept_rows(rows, spec), current_table, counts)
            stamp = F.current_timestamp() if recorded_at is None else F.lit(str(recorded_at)).cast("timestamp")
            new = history_record(counts, "path", stamp, "flagged", keep=["feed"])
            append_changes(spark, history_table, lambda held: change_gate(
                new, with_feed_and_time(held), ["feed"], HISTORY_ORDER).select(*held.columns))
    return totals


def _refused(bad: DataFrame, rejected: int) -> str:
    """What the error says; all rejects, where there are several, go to a folder that stays."""
    one = bad.first()
    if rejected == 1:
        return f"1 workbook(s) cannot be loaded: {one.path}: {one.reason}"
    folder = shared_folder(bad.sparkSession)
    bad.write.json(folder)
    return f"{rejected} workbook(s) cannot be loaded, listed in {folder}; one of them: {one.path}: {one.reason}"
