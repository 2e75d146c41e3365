"""Row and flag counts, in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwell.functions.cells import non_blank


def load_stats(
    df: DataFrame, key: str, flag: str | None = None, by: Sequence[str] = (), row_no: str | None = None,
) -> DataFrame:
    """Rows read, rows kept (key not blank) and flags set among the kept rows.

    A flag counts when it is not NULL, whatever its text. No flag column, or no
    rows, counts 0. With ``row_no`` the rows are those of sheets, of which row 0 is the header and
    blank ones are left out: the last number is the rows read. All buffers are longs: a hash
    aggregate with map-side combine, whose shuffle has one row per group and task.
    """
    kept = non_blank(key) if row_no is None else non_blank(key) & (F.col(row_no) > 0)
    read = F.count(F.lit(1)) if row_no is None else F.max(row_no)
    flagged = F.lit(0).cast("long") if flag is None else F.count(F.when(kept, F.col(flag)))
    return df.groupBy(*by).agg(
        read.alias("rows_read"), F.count_if(kept).alias("rows_kept"), flagged.alias("flagged"),
    )


def flag_counts(kept: DataFrame, flag: str = "flag", by: Sequence[str] = ()) -> DataFrame:
    """Rows and set flags of rows whose blank keys are already dropped."""
    return kept.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_kept"), F.count(flag).alias("flagged"),
    )
