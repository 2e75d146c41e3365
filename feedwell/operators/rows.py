"""Canonical rows: fixed column names, blank keys dropped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwell.functions.cells import non_blank


def canonical_rows(
    df: DataFrame, columns: Mapping[str, Column | str], flag: Column | str | None = None,
    keep: tuple[str, ...] = (), has_flag: Column | None = None,
) -> DataFrame:
    """Select ``columns`` under their canonical names, all as strings.

    The result always has ``flag`` and ``has_flag``, so that files with and
    without a flag column share one table: without one, ``flag`` is NULL.
    ``has_flag`` tells which rows come from a file with one; by default all do if ``flag`` is given.
    """
    return df.select(
        *keep,
        *[_column(c).cast("string").alias(name) for name, c in columns.items()],
        (F.lit(None) if flag is None else _column(flag)).cast("string").alias("flag"),
        (F.lit(flag is not None) if has_flag is None else has_flag).alias("has_flag"),
    )


def drop_blank_keys(df: DataFrame, key: str) -> DataFrame:
    """Keep the rows whose key is neither null nor blank."""
    return df.filter(non_blank(key))


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
