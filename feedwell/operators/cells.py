"""What stored cells mean: text, numbers, dates, elapsed times, booleans, errors, as Column expressions.

A stored cell is a struct (kind, style, raw) as ``read_parts`` gives it. Its meaning is text; NULL
stands for errors and for what cannot be read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The built-in number formats that show a date or a time, and the one of them that
#: shows an elapsed time.
DATE_FORMATS, ELAPSED_FORMAT = (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47), 46
#: What a style shows.
PLAIN, DATE, ELAPSED = 0, 1, 2
_DAY_MS = 86_400_000


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def shown(formats: Column | str) -> Column:
    """Per number format (its code, or ``id:`` and a built-in number) whether it shows a date or an elapsed time."""

    def one(code: Column) -> Column:
        bare = F.regexp_replace(F.split(code, ";", 2)[0], '"[^"]*"', "")
        letters = F.regexp_replace(bare, r"\[[^\]]*\]|[\\_].", "")
        custom = F.when(bare.rlike(r"(?i)\[(h{1,2}|m{1,2}|s{1,2})\]"), ELAPSED).when(letters.rlike("(?i)[dmyhs]"), DATE).otherwise(PLAIN)
        built_in = F.when(code == f"id:{ELAPSED_FORMAT}", ELAPSED).when(
            code.isin(*[f"id:{n}" for n in DATE_FORMATS]), DATE).otherwise(PLAIN)
        return F.when(code.startswith("id:"), built_in).otherwise(custom)

    return F.transform(formats, one)


def cell_text(cell: Column, styles: Column | str, date1904: Column | str) -> Column:
    """The text of a stored cell; ``styles`` as ``shown`` gives them."""
    kind, raw = cell["kind"], cell["raw"]
    style = F.coalesce(F.get(styles, cell["style"]), F.lit(PLAIN))
    first = F.col(date1904) if isinstance(date1904, str) else date1904
    styled = F.when(style == ELAPSED, _with(_read(raw), _elapsed)).when(
        style == DATE, _with(_read(raw), lambda n: _moment(n, first)))
    value = F.when(style != PLAIN, styled).when(raw.rlike(r"^-?\d+$"), _whole(raw)).otherwise(_with(_read(raw), _number))
    return (
        F.when(kind.isin("s", "inlineStr", "str"), raw)
        .when(kind == "n", value)
        .when(kind == "b", F.when(raw.try_cast("int") == 0, "False").when(raw.rlike(r"^\s*[+-]?\d+\s*$"), "True"))
        .when(kind == "d", F.when(F.contains(raw, F.lit("T")), _iso(raw)).otherwise(raw))
    )


def _read(raw: Column) -> Column:
    """The number that a text stands for."""
    return F.when(raw.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), F.trim(raw).try_cast("double"))


def _whole(raw: Column) -> Column:
    """Digits as they are, without leading zeros: whole numbers of any length stay exact."""
    digits = F.regexp_replace(F.ltrim(raw, F.lit("-")), "^0+(?=.)", "")
    signed = F.concat(F.when(raw.startswith("-") & (digits != "0"), "-").otherwise(""), digits)
    return F.when(raw.rlike("^-?[1-9]"), raw).otherwise(signed)


def _number(number: Column) -> Column:
    """A number as short as it can be told from others: 7, 7.5, 1e-05."""
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    small = (F.abs(number) >= 1e-3) & (F.abs(number) < 1e7)  # what a cast writes without an exponent
    plain = F.regexp_replace(number.cast("string"), r"\.0$", "")
    return F.when(finite, F.when(number == 0, "0").when(small, plain).otherwise(_with(number.cast("string"), _spread)))


def _spread(shortest: Column) -> Column:
    """A number written with an exponent: without it up to 16 digits before the point and 4 zeros after it."""
    parts = F.split(shortest, "E")
    exponent = F.coalesce(F.get(parts, F.lit(1)).cast("int"), F.lit(0))
    mantissa = F.regexp_replace(F.get(parts, F.lit(0)), r"\.0$", "")
    digits = F.regexp_replace(shortest.try_cast("decimal(38,21)").cast("string"), r"(\.\d*?)0+$", "$1")
    large = F.coalesce(shortest.try_cast("decimal(38,0)").cast("string"), F.concat(mantissa, F.lit("e+"), exponent.cast("string")))
    tiny = F.concat(mantissa, F.lit("e-"), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    return F.when(exponent < -4, tiny).when(exponent >= 16, large).otherwise(F.regexp_replace(digits, r"\.$", ""))


def _clock(ms: Column) -> Column:
    """Minutes, seconds and, if there is any, the fraction of a second in micros, of milliseconds of a day."""
    rest = F.pmod(ms, F.lit(1000))
    at = lambda unit, size: F.lpad(F.pmod(F.floor(ms / unit), F.lit(size)).cast("string"), 2, "0")
    fraction = F.when(rest > 0, F.concat(F.lit("."), F.lpad(rest.cast("string"), 3, "0"), F.lit("000"))).otherwise("")
    return F.concat(at(60_000, 60), F.lit(":"), at(1000, 60), fraction)


def _elapsed(number: Column) -> Column:
    """Days, if there are any, and hours, minutes and seconds."""
    ms = F.rint(number * _DAY_MS).cast("long")
    days = F.floor(ms / _DAY_MS)
    rest = ms - days * _DAY_MS
    named = F.concat(days.cast("string"), F.when(F.abs(days) == 1, " day, ").otherwise(" days, "))
    hours = F.floor(rest / 3_600_000).cast("string")
    return F.concat(F.when(days == 0, "").otherwise(named), hours, F.lit(":"), _clock(rest))


def _moment(number: Column, date1904: Column) -> Column:
    """Date and time of a serial number; a time alone in day 0; NULL beyond the years 1 to 9999."""
    days = F.floor(number)
    ms = F.rint((number - days) * _DAY_MS).cast("long")
    # A last half of a millisecond may fill the day.
    total, rest = days + F.floor(ms / _DAY_MS), F.pmod(ms, F.lit(_DAY_MS))
    # The 1900 calendar counts a 29 February 1900 that never was.
    late = F.when(~date1904 & (number > 0) & (number < 60), F.lit(1)).otherwise(0)
    zero = F.when(date1904, F.lit("1904-01-01").cast("date")).otherwise(F.lit("1899-12-30").cast("date"))
    day = F.date_add(zero, F.when(F.abs(number) < 4_000_000, total + late).cast("int"))
    dated = _with(day, lambda d: F.when(F.year(d).between(1, 9999), F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" "))))
    time = _with(rest, lambda r: F.concat(F.lpad(F.floor(r / 3_600_000).cast("string"), 2, "0"), F.lit(":"), _clock(r)))
    return F.concat(F.when((number >= 0) & (number < 1) & (total == 0), "").otherwise(dated), time)


def _iso(raw: Column) -> Column:
    at = raw.try_cast("timestamp_ntz")
    micros = F.date_format(at, "SSSSSS")
    return F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""))


def decode_cells(parts: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The rows of parts of sheets: (carry, sheet_no, row_no, cells), ``cells`` the text by position.

    Blank rows and cells have no entry; errors are NULL.
    """
    rows = parts.withColumn("__styles", shown("formats")).select(
        *carry, "sheet_no", "date1904", "__styles", F.inline("rows"))
    text = F.transform_values("cells", lambda _, c: cell_text(c, F.col("__styles"), F.col("date1904")))
    return rows.select(*carry, "sheet_no", "row_no", text.alias("cells"))


def header_texts(styles: Column) -> Column:
    """The headers of a part in order, as text; errors are empty."""
    return F.transform("head", lambda h: F.coalesce(cell_text(h["cell"], styles, F.col("date1904")), F.lit("")))


def list_headers(parts: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Headers as a table (carry, ordinal, header); a sheet without any has one row of NULLs.

    Expects the first part of each sheet, as ``read_parts`` gives with ``header_only``.
    """
    named = parts.withColumn("__styles", shown("formats")).withColumn("__headers", header_texts(F.col("__styles")))
    spots = F.zip_with("head", "__headers", lambda h, t: F.struct(h["at"].alias("ordinal"), t.alias("header")))
    return named.select(*carry, F.inline_outer(spots))
