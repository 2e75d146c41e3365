"""File names and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(col: Column | str) -> Column:
    """What follows the last slash."""
    return F.substring_index(col, "/", -1)


def minute_stamp(col: Column | str) -> Column:
    """A timestamp as text, to the minute, in the session's time zone."""
    return F.date_format(col, "yyyy-MM-dd HH:mm")
