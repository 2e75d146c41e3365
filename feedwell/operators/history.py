"""History records and the change gate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwell.functions.paths import basename, minute_stamp

RECORD = ("filename", "flagged_line_count")


def history_record(
    counted: DataFrame, path: Column | str, recorded_at: Column, flagged: Column | str, keep: Sequence[str] = (),
) -> DataFrame:
    """One record per input row: file name, minute stamp, flag count, exact time."""
    flagged = F.col(flagged) if isinstance(flagged, str) else flagged
    return counted.select(
        *keep,
        basename(path).alias("filename"),
        minute_stamp(recorded_at).alias("processing_timestamp"),
        flagged.cast("long").alias("flagged_line_count"),
        recorded_at.alias("recorded_at"),
    )


def latest_record(history: DataFrame, order: Sequence[str]) -> DataFrame:
    """The newest record of a whole table: a top-1 per partition, merged, no full sort."""
    return history.orderBy(*[F.desc(c) for c in order]).limit(1)


def latest_per(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per group, by ``order``; ties go to the greater remaining columns.

    The newest first order value per group is a hash aggregate, combined on the map side, whose
    result goes back to the rows; only rows that hold it, one per group if it is unique, are
    sorted to break ties. NULL is a group like any other, and older than any value.
    """
    first = order[0]
    newest = df.groupBy(*[F.col(c).alias(f"__by_{c}") for c in by]).agg(F.max(first).alias("__newest"))
    held = df.join(newest, _same([*by]) & F.col(first).eqNullSafe(F.col("__newest")), "left_semi")
    rest = [c for c in df.columns if c not in (*by, *order)]
    ranked = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in (*order, *rest)])
    return held.withColumn("__rank", F.row_number().over(ranked)).filter(F.col("__rank") == 1).select(*df.columns)


def _same(by: Sequence[str]) -> Column:
    """Equal groups, NULL included: columns against those renamed to ``__by_...``."""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by])


def change_gate(
    new: DataFrame, history: DataFrame, by: Sequence[str], order: Sequence[str],
    compare: Sequence[str] = RECORD,
) -> DataFrame:
    """New records that differ from the latest record of their feed, or have none.

    Only the latest record counts: A, B, A passes three times, A, A once. A NULL feed is a feed.
    Both sides of the join have one row per feed; no broadcast is forced, Spark picks one from the
    measured size.
    """
    latest = latest_per(history.select(*by, *order, *compare), by, order)
    latest = latest.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.struct(*compare).alias("__latest"))
    # A feed without history joins to a NULL struct, which equals no record.
    same = F.struct(*compare).eqNullSafe(F.col("__latest"))
    return new.join(latest, _same(by), "left").filter(~same).select(*new.columns)


def keep_changes(
    df: DataFrame, by: Sequence[str], order: Sequence[str], compare: Sequence[str],
) -> DataFrame:
    """First row of each feed and every row that differs from the one before it.

    The same answer as ``lag`` over (by, order), but no feed has to fit in one
    task. Rows of a feed that tie in ``order`` come in any order, so they should
    be copies of each other.

    1. Rows are spread by range over (by, order, source partition), which splits
       a large feed, and a large group of copies, at sampled bounds; the range
       each row fell in is its slot.
    2. Inside (by, slot) a window compares each row with the one before it.
       Only changed rows and the two ends of each slot go on.
    3. The ends of a feed's slots, two rows per slot, meet in one small group,
       where the first row of a slot sees the last row of the slot before. The
       other rows keep their slot as group and are already decided.
    """
    state = F.struct(*compare)
    line = [*order, "__source"]
    spread = (
        df.withColumn("__source", F.spark_partition_id())
        .repartitionByRange(*by, *line)
        .withColumn("__slot", F.spark_partition_id())
    )
    inside = Window.partitionBy(*by, "__slot").orderBy(*line)
    before = F.lag(state).over(inside)
    edged = spread.withColumns({
        "__first": before.isNull(),
        "__last": F.lead(state).over(inside).isNull(),
        "__changed": ~before.eqNullSafe(state),
    })
    reduced = edged.filter(F.col("__first") | F.col("__last") | F.col("__changed")).withColumn(
        "__group", F.when(F.col("__first") | F.col("__last"), F.lit(-1)).otherwise(F.col("__slot"))
    )
    across = Window.partitionBy(*by, "__group").orderBy(*line, F.desc("__first"))
    decided = reduced.withColumn("__across", ~F.lag(state).over(across).eqNullSafe(state))
    return decided.filter(
        F.when(F.col("__first"), F.col("__across")).otherwise(F.col("__changed"))
    ).select(*df.columns)
