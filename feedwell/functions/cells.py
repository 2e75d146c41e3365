"""Blank and missing cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a spreadsheet reader takes for a missing cell.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def non_blank(col: Column | str) -> Column:
    """Not null and not empty after trimming spaces (tabs and newlines count as text)."""
    col = F.col(col) if isinstance(col, str) else col
    return col.isNotNull() & (F.trim(col) != "")


def missing_to_null(col: Column, words: Sequence[str] = NA_WORDS) -> Column:
    """NULL where the cell holds one of ``words``."""
    return F.when(~col.isin(*words), col) if words else col
