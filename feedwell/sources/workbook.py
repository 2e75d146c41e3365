"""Workbooks as tables of stored cells.

1. One pass over the bytes of each workbook opens it, finds the sheets and their headers, and cuts the
   XML of the sheets, and of the shared strings if a sheet refers to any, into blocks.
2. The blocks of a sheet, however large, are dealt over tasks, which read their cells.
3. Shared strings are a table (workbook, number, text), read from blocks as well. It is joined to the
   numbers that the cells of a part of a sheet refer to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwell.functions.names import key_of, plain, prefix_key
from feedwell.sources.ooxml import BLOCK_BYTES, Book, block_rows, block_strings

#: Rows and characters of a part of a sheet.
PART_ROWS, PART_CHARS = 1_000, 4_000_000
#: Rows and bytes of a batch of parts or blocks.
ROWS_PER_BATCH, BYTES_PER_BATCH = 10_000, 16_000_000

Stage = Callable[[DataFrame], DataFrame]
"""Writes a table once and reads it back, so that steps behind it do not compute it again."""

_CELL = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("style", T.IntegerType()), T.StructField("raw", T.StringType()),
])
_CELLS = T.MapType(T.LongType(), _CELL)
_HEAD = T.ArrayType(T.StructType([
    T.StructField("at", T.LongType()), T.StructField("cell", _CELL), T.StructField("plain", T.StringType()),
]))
_ROWS = T.ArrayType(T.StructType([T.StructField("row_no", T.LongType()), T.StructField("cells", _CELLS)]))
#: ``sure``: a cell with text is known; ``doubt``: numbers of shared strings in skipped cells, which may be empty.
_READ_ROWS = T.ArrayType(T.StructType([
    *_ROWS.elementType, T.StructField("sure", T.BooleanType()), T.StructField("doubt", T.ArrayType(T.LongType())),
]))
_SHEET = [
    T.StructField("sheets", T.ArrayType(T.StringType())), T.StructField("sheet_no", T.IntegerType()),
    T.StructField("sheet", T.StringType()), T.StructField("part_no", T.LongType()),
    T.StructField("date1904", T.BooleanType()), T.StructField("formats", T.ArrayType(T.StringType())),
    T.StructField("head", _HEAD), T.StructField("error", T.StringType()), T.StructField("book", T.StringType()),
]
_BLOCK = [
    *_SHEET, T.StructField("prefix", T.StringType()), T.StructField("first", T.LongType()),
    T.StructField("xml", T.BinaryType()), T.StructField("size", T.LongType()),
]
_PART = [
    *_SHEET, T.StructField("rows", _READ_ROWS), T.StructField("wanted", T.ArrayType(T.LongType())), T.StructField("size", T.LongType()),
]
_ARROW_CELL = pa.struct([("kind", pa.string()), ("style", pa.int32()), ("raw", pa.string())])
_ARROW_SHEET = [
    ("sheets", pa.list_(pa.string())), ("sheet_no", pa.int32()), ("sheet", pa.string()), ("part_no", pa.int64()),
    ("date1904", pa.bool_()), ("formats", pa.list_(pa.string())),
    ("head", pa.list_(pa.struct([("at", pa.int64()), ("cell", _ARROW_CELL), ("plain", pa.string())]))),
    ("error", pa.string()), ("book", pa.string()),
]
_ARROW_BLOCK = pa.schema([
    *_ARROW_SHEET, ("prefix", pa.string()), ("first", pa.int64()), ("xml", pa.binary()), ("size", pa.int64()),
])
_ARROW_PART = pa.schema([
    *_ARROW_SHEET,
    ("rows", pa.list_(pa.struct([
        ("row_no", pa.int64()), ("cells", pa.map_(pa.int64(), _ARROW_CELL)), ("sure", pa.bool_()), ("doubt", pa.list_(pa.int64())),
    ]))),
    ("wanted", pa.list_(pa.int64())), ("size", pa.int64()),
])
_TEXT_KINDS = ("s", "inlineStr", "str")
#: Whether a part has numbers of shared strings.
_REFERS = "size(wanted) > 0"
#: ``part_no`` of what is not a part of a sheet: a block of shared strings.
_STRINGS = -1
#: Numbers of parts within a block, below that of the block.
_PARTS_OF_BLOCK = 1 << 20


def read_parts(
    files: DataFrame, carry: Sequence[str], sheet_prefix: str | None = None, header_only: bool = False,
    columns: Sequence[str] | None = None, content: str = "content", stage: Stage | None = None,
) -> DataFrame:
    """The stored cells of each workbook's sheets, in parts of up to ``PART_ROWS`` rows.

    Gives (carry, sheets, sheet_no, sheet, part_no, date1904, formats, head, rows, error). ``sheets``
    are all names in workbook order; ``head`` are the cells of row 0, in every part, with ``plain``
    the NFKD of text without what is not ASCII; ``rows`` leave out blank rows. A sheet has at least
    one part, and ``part_no`` ascends from 0 in it, with gaps. With ``sheet_prefix`` only the first
    sheet whose key starts with it is read, and a workbook without one is one row without ``sheet_no``.
    ``columns`` are header prefixes: cells under a text header that starts with none of them are
    skipped, but their rows stay.

    A workbook that cannot be opened, or is found damaged part way, gets rows with ``error``; its other
    rows must then be dropped. ``stage`` keeps blocks and cells that two steps read; without it they
    are read twice.
    """
    wanted = None if sheet_prefix is None else prefix_key(sheet_prefix)
    kept = None if columns is None else tuple(prefix_key(c) for c in columns)
    inputs = files.select(*carry, F.col(content).alias("__content"))
    own = [inputs.schema[c] for c in carry]
    about = [*carry, *[f.name for f in _SHEET if f.name not in ("book", "error")]]
    unpacked = _mapped(
        inputs, [*own, *_BLOCK], len(carry), _ARROW_BLOCK,
        lambda row: _blocks(row.column(len(carry))[0].as_py(), wanted, header_only))
    if header_only:
        return unpacked.select(*about, F.array().cast(_ROWS).alias("rows"), "error")
    blocks = unpacked if stage is None else stage(unpacked)
    parts = _mapped(
        _dealt(blocks.filter(F.col("part_no") != _STRINGS), stage is not None).select(*carry, *[f.name for f in _BLOCK]),
        [*own, *_PART], len(carry), _ARROW_PART, lambda row: _parts(row.slice(0, 1).to_pylist()[0], kept))
    parts = parts if stage is None else stage(parts)
    if stage is not None and parts.filter(_REFERS).isEmpty():
        return parts.withColumn("rows", F.transform("rows", _plain_row)).select(*about, "rows", "error")
    return _resolved(parts, _strings(blocks)).select(*about, "rows", "error")


def _dealt(blocks: DataFrame, counted: bool) -> DataFrame:
    """The blocks in partitions of about a block's bytes each, where they can be counted, else by Spark's own number."""
    if not counted:
        return blocks.repartition("book", "sheet_no", "part_no")
    about = blocks.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    return blocks.repartition(max(1, min(about.n, -(-(about.size or 0) // BLOCK_BYTES))))


def _mapped(
    rows: DataFrame, schema: list[T.StructField], carried: int, arrow: pa.Schema, each: Callable[[pa.RecordBatch], Iterator[dict]],
) -> DataFrame:
    """``each`` of every row, given as a batch of one, with the first columns of the row before what it gives."""
    names = [f.name for f in schema]

    def together(batch: pa.RecordBatch, owners: list[int], found: list[dict]) -> pa.RecordBatch:
        columns = pa.RecordBatch.from_pylist(found, arrow).columns
        return pa.RecordBatch.from_arrays([*batch.select(range(carried)).take(pa.array(owners, pa.int64())).columns, *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners: list[int] = []
            found: list[dict] = []
            size = 0
            for n in range(batch.num_rows):
                for row in each(batch.slice(n, 1)):
                    owners.append(n)
                    found.append(row)
                    size += row["size"]
                    if len(found) >= 256 or size >= PART_CHARS:
                        yield together(batch, owners, found)
                        owners, found, size = [], [], 0
            if found:
                yield together(batch, owners, found)

    return rows.mapInArrow(lambda batches: joined(run(batches)), T.StructType(schema))


def _blocks(content: bytes | None, wanted: str | None, header_only: bool) -> Iterator[dict]:
    """The blocks of the sheets that are wanted, and of the shared strings if these sheets refer to any."""
    blank = {**dict.fromkeys(_ARROW_BLOCK.names), "part_no": 0, "size": 0}
    try:
        book = Book(content)
        names = [name for name, _ in book.sheets]
        numbers = range(len(names)) if wanted is None else [n for n, s in enumerate(names) if key_of(s).startswith(wanted)][:1]
        about = {**blank, "sheets": names, "date1904": book.date1904, "formats": book.formats, "book": hashlib.md5(content).hexdigest()}
    except Exception as problem:  # any damage makes this one workbook a reject
        yield {**blank, "error": f"unreadable workbook: {_message(problem)}"}
        return
    if wanted is not None and not numbers:
        yield about
    shared = False
    for number in numbers:
        name, member = book.sheets[number]
        sheet = {**about, "sheet_no": number, "sheet": name}
        try:
            sheet["head"] = _head(book, member)
            if header_only:
                yield sheet
                continue
            for part, (prefix, first, xml) in enumerate(book.blocks(member)):
                shared = shared or _SHARED_CELL.search(xml) is not None
                yield {**sheet, "part_no": part * _PARTS_OF_BLOCK, "prefix": prefix, "first": first, "xml": xml, "size": len(xml)}
        except Exception as problem:
            yield {**sheet, "error": f"unreadable sheet: {_message(problem)}"}
            return
    if not shared:
        return
    try:
        for prefix, first, xml in book.string_blocks():
            yield {**blank, "book": about["book"], "part_no": _STRINGS, "prefix": prefix, "first": first, "xml": xml, "size": len(xml)}
    except Exception as problem:
        yield {**about, "error": f"unreadable shared strings: {_message(problem)}"}


_SHARED_CELL = re.compile(rb"""\st\s*=\s*["']s["']""")


def _head(book: Book, member: str) -> list[dict]:
    cells = book.header(member)
    numbers = {at: _number(raw) for at, kind, _, raw in cells if kind == "s"}
    strings = book.strings({n for n in numbers.values() if n is not None})
    found = []
    for at, kind, style, raw in cells:
        if kind == "s":
            kind, raw = ("s", strings[numbers[at]]) if numbers[at] in strings else ("e", raw)
        if raw or kind == "e":
            text = plain(raw) if kind in _TEXT_KINDS else None
            found.append({"at": at, "cell": {"kind": kind, "style": style, "raw": raw}, "plain": text})
    return found


def _number(raw: str) -> int | None:
    """The number of a shared string; None if there can be none."""
    try:
        number = int(raw)
    except ValueError:
        return None
    return number if 0 <= number < 1 << 63 else None


def _parts(block: dict, kept: tuple | None) -> Iterator[dict]:
    """The cells of a block, in parts; a damaged one ends with a part that says so."""
    about = {name: block[name] for name, _ in _ARROW_SHEET}
    part = {**about, "rows": [], "wanted": [], "size": 0}
    if block["xml"] is None:
        yield part
        return
    skipped = set() if kept is None else {
        h["at"] for h in about["head"] if h["plain"] is not None and not key_of(h["plain"]).startswith(kept)}
    size, number, wanted = 0, about["part_no"], set()
    try:
        for row_no, cells in block_rows(block["prefix"], block["first"], block["xml"]):
            row, refers = _row(row_no, cells, skipped)
            if row is None:
                continue
            part["rows"].append(row)
            wanted |= refers
            size += sum(len(cell["raw"]) for _, cell in row["cells"])
            if len(part["rows"]) >= PART_ROWS or size >= PART_CHARS:
                yield {**part, "part_no": number, "wanted": sorted(wanted), "size": size}
                part, size, number, wanted = {**part, "rows": []}, 0, number + 1, set()
        if part["rows"] or number == 0:
            yield {**part, "part_no": number, "wanted": sorted(wanted), "size": size}
    except Exception as problem:
        yield {**about, "part_no": number, "rows": [], "wanted": [], "size": 0, "error": f"unreadable sheet: {_message(problem)}"}


def _row(row_no: int, cells: list[tuple], skipped: set[int]) -> tuple[dict | None, set[int]]:
    """A row, and the numbers of the shared strings that it needs; None if it has no cell with text."""
    own, refers, doubt, sure = [], set(), set(), False
    for at, kind, style, raw in cells:
        number = None
        if kind == "s":
            number = _number(raw)
            kind, raw = ("e", raw) if number is None else (kind, str(number))
        if number is None:
            if not raw and kind != "e":
                continue
            sure = True
        if at not in skipped:
            own.append((at, {"kind": kind, "style": style, "raw": raw}))
            refers |= set() if number is None else {number}
        elif number is not None:
            doubt.add(number)
    if sure:
        doubt = set()
    if not (sure or own or doubt):
        return None, set()
    return {"row_no": row_no, "cells": list(dict(own).items()), "sure": sure, "doubt": sorted(doubt)}, refers | doubt


def _strings(blocks: DataFrame) -> DataFrame:
    """(book, number, text) of all shared strings; a damaged block gives its error and no number.

    The blocks of a table, however large, are dealt over tasks. Equal workbooks give equal strings again.
    """
    schema = pa.schema([("book", pa.string()), ("number", pa.int64()), ("text", pa.string()), ("error", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                (row,) = batch.slice(n, 1).to_pylist()
                held, error = [], None
                try:
                    for text in block_strings(row["prefix"], row["xml"]):
                        held.append(text)
                except Exception as problem:
                    error = f"unreadable shared strings: {_message(problem)}"
                numbers = range(row["first"], row["first"] + len(held))
                rows = [{"book": row["book"], "number": n, "text": t} for n, t in zip(numbers, held)]
                yield pa.RecordBatch.from_pylist(rows if error is None else [{"book": row["book"], "error": error}], schema)

    own = blocks.filter(F.col("part_no") == _STRINGS).select("book", "first", "prefix", "xml")
    return own.repartition("book", "first").mapInArrow(read, "book string, number long, text string, error string")


def _resolved(parts: DataFrame, strings: DataFrame) -> DataFrame:
    """The parts with shared strings in place of their numbers, and without cells and rows that are empty then."""
    key = ["book", "sheet_no", "part_no"]
    needs = parts.filter(_REFERS).select(*key, F.explode("wanted").alias("number")).distinct()
    pair = F.struct("number", "text")
    texts = needs.join(strings.filter("error is null").select("book", "number", "text"), ["book", "number"])
    texts = texts.groupBy(*key).agg(F.map_from_entries(F.collect_set(pair)).alias("texts"))
    damaged = strings.filter("error is not null").groupBy("book").agg(F.array_min(F.collect_set("error")).alias("damage"))
    found = parts.filter(_REFERS).join(texts, key, "left").join(damaged, "book", "left")
    found = found.withColumn("error", F.coalesce("error", "damage")).withColumn("rows", _with_texts(F.col("rows"), F.col("texts")))
    whole = parts.filter(f"not ({_REFERS})").withColumn("rows", F.transform("rows", _plain_row))
    return whole.unionByName(found.select(whole.columns))


def _plain_row(row: Column) -> Column:
    return F.struct(row["row_no"].alias("row_no"), row["cells"].alias("cells"))


def _with_texts(rows: Column, texts: Column) -> Column:
    def cell(stored: Column) -> Column:
        text = F.try_element_at(texts, stored["raw"].try_cast("long"))
        known = F.struct(
            F.when(text.isNull(), "e").otherwise("s").alias("kind"), stored["style"].alias("style"),
            F.coalesce(text, stored["raw"]).alias("raw"))
        return F.when(stored["kind"] == "s", known).otherwise(stored)

    def row(read: Column) -> Column:
        cells = F.transform_values(read["cells"], lambda _, c: cell(c))
        filled = F.map_filter(cells, lambda _, c: (c["raw"] != "") | (c["kind"] == "e"))
        # A number without a string is an error, which is not blank.
        beside = F.exists(read["doubt"], lambda n: F.coalesce(F.try_element_at(texts, n) != "", F.lit(True)))
        return F.struct(read["row_no"].alias("row_no"), filled.alias("cells"), (read["sure"] | beside).alias("sure"))

    held = F.filter(F.transform(rows, row), lambda r: r["sure"] | (F.size(r["cells"]) > 0))
    return F.transform(held, _plain_row)


def _message(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches joined into larger ones: a batch costs the same however small."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows >= ROWS_PER_BATCH or size >= BYTES_PER_BATCH:
            yield pa.concat_batches(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.concat_batches(held)
