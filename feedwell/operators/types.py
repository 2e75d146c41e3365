"""Types of text columns, inferred from all their values in one aggregate.

Each value sets flags for the types that it rules out; flags of a column are joined by bitwise or, on
the map side and over parts, feeds or runs alike, so inferred types of parts can be merged. A value
rules a type out unless it is written just as the type would write it: ``007`` is text, not 7.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Flags of a value: there is one; it is no whole number, no number, no boolean, no date, no date with time.
SEEN, NOT_WHOLE, NOT_NUMBER, NOT_BOOLEAN, NOT_DATE, NOT_TIME = 1, 2, 4, 8, 16, 32
#: From narrow to wide: the type of a column none of whose values sets the flag.
_TYPES = ((NOT_BOOLEAN, "boolean"), (NOT_WHOLE, "bigint"), (NOT_NUMBER, "double"), (NOT_DATE, "date"), (NOT_TIME, "timestamp_ntz"))
TEXT = "string"


def value_flags(value: Column) -> Column:
    """The flags of a text; 0 of NULL, which is a value of every type."""
    whole = value.rlike(r"^(0|-?[1-9]\d{0,18})$") & value.try_cast("bigint").isNotNull()
    number = value.rlike(r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$") & value.try_cast("double").isNotNull()
    date = value.rlike(r"^\d{4}-\d\d-\d\d( 00:00:00)?$") & F.left(value, F.lit(10)).try_cast("date").isNotNull()
    time = value.rlike(r"^\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d(\.\d{1,6})?)?$") & value.try_cast("timestamp_ntz").isNotNull()
    ruled_out = (
        (NOT_WHOLE, whole), (NOT_NUMBER, number), (NOT_BOOLEAN, value.isin("True", "False")), (NOT_DATE, date), (NOT_TIME, time),
    )
    flags = F.lit(SEEN)
    for flag, fits in ruled_out:
        flags = flags + F.when(fits, 0).otherwise(flag)
    return F.when(value.isNull(), 0).otherwise(flags)


def type_flags(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The joined flags of each column, under its name, per group."""
    return df.groupBy(*by).agg(*[F.bit_or(value_flags(F.col(c).cast("string"))).alias(c) for c in columns])


def merge_flags(flags: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Flags of parts as those of the whole."""
    return flags.groupBy(*by).agg(*[F.bit_or(c).alias(c) for c in columns])


def type_name(flags: Column) -> Column:
    """The narrowest type that no flag rules out; text for a column without values."""
    flags = F.coalesce(flags, F.lit(0))
    name = F.when(flags == 0, TEXT)
    for flag, kind in _TYPES:
        name = name.when(flags.bitwiseAND(flag) == 0, kind)
    return name.otherwise(TEXT)


def infer_types(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, type) of each column."""
    flags = type_flags(df, columns, by)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), type_name(F.col(c)).alias("type")) for c in columns])
    return flags.select(*by, F.inline(pairs))


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns under their types, as ``infer_types`` names them; a value that does not fit is NULL."""
    known = {TEXT, *[kind for _, kind in _TYPES]}
    if wrong := set(types.values()) - known:
        raise ValueError(f"unknown types {sorted(wrong)}")

    def cast(name: str, kind: str) -> Column:
        text = F.col(name).cast("string")
        return (F.left(text, F.lit(10)) if kind == "date" else text).try_cast(kind)

    return df.withColumns({c: cast(c, t) for c, t in types.items()})


def with_inferred_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns under the types inferred from all rows: one aggregate, whose one row comes to the driver."""
    return typed(df, {r.column: r.type for r in infer_types(df, columns).collect()})
