
from __future__ import annotations

import re
import tempfile
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import wraps
from uuid import uuid4

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import feedwell
from feedwell.functions import basename, key_text, marker_text, minute_stamp, non_blank
from feedwell.operators import (
    canonical_rows, change_gate, decode_cells, drop_blank_keys, flag_counts, header_texts, history_record, infer_types, keep_changes,
    latest_per, latest_record, list_headers, load_stats, missing_columns, resolve_flag, resolve_headers,
    resolve_headers_all, resolve_targets, shown, with_inferred_types,
)
from feedwell.plans import FeedSpec, feed_counts, ingest_loaded, rejects, sheet_rows
from feedwell.plans.load import kept_rows
from feedwell.sinks import append_history, read_history, shared_folder, staging, write_current
from feedwell.sources import count_files, latest_files, listing, match_names, open_directory, read_files, read_parts
from feedwell.testing.books import Raw, books_of

# The package's functions travel with the tasks, so that workers need no copy of it.
cloudpickle.register_pickle_by_value(feedwell)

SMOKE_DIR = "/root/testdata/sf0.001"
RECORD = ["filename", "processing_timestamp", "flagged_line_count"]


def entry(spark: SparkSession) -> DataFrame:
    """Flagged rows per source, as history records that pass the gate of an empty history."""
    return _gate_first(spark, SMOKE_DIR)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- names, paths, stamps ----------------------------------------------------


def _normalise_key(spark, d):
    return _table(spark, d, "documents").select("doc_id", F.md5(key_text("text")).alias("key_md5"))


def _normalise_substring(spark, d):
    return _table(spark, d, "documents").select("doc_id", F.md5(marker_text("text")).alias("key_md5"))


def _path_filter(spark, d):
    pages = _table(spark, d, "pages").select("page_id", "url")
    return match_names(pages, r"^[^ ]+\.html$", path="url")


def _basename(spark, d):
    return _table(spark, d, "pages").select("page_id", basename("url").alias("name"))


def _minute_stamp(spark, d):
    return _table(spark, d, "events").select("event_id", minute_stamp("ts").alias("stamp"))


# --- files ------------------------------------------------------------------


def _listing(spark, d):
    """The event table as a directory listing, and the files in it that a feed would take."""
    ending = F.when(F.col("value") > 100, ".xlsx").when(F.col("value") > 50, " copy.xlsx").otherwise(".xls")
    files = _table(spark, d, "events").select(
        F.concat(F.lit("/in/"), "event_type", F.lit("_"), "event_id", ending).alias("path"),
        F.col("ts").alias("modificationTime"), F.col("user_id").alias("length"),
    )
    return match_names(files, r"^[a-z]+_[^ ]+\.xlsx$")


def _feed():
    return F.substring_index(basename("path"), "_", 1)


def _candidate_count(spark, d):
    return count_files(_listing(spark, d), _feed())


def _latest_file(spark, d):
    newest = latest_files(_listing(spark, d))
    return newest.select("path", minute_stamp("modificationTime").alias("stamp"), "length")


def _latest_files(spark, d):
    newest = latest_files(_listing(spark, d), _feed())
    return newest.select("feed", "path", minute_stamp("modificationTime").alias("stamp"), "length")


def _file_lines(spark, d):
    """A table written as text files, which are then listed and read. The files stay: the result reads them."""
    folder = shared_folder(spark)
    lines = F.concat_ws("|", "doc_id", "lang", "source")
    _table(spark, d, "documents").select(lines.alias("value")).write.text(folder)
    directory = open_directory(spark, folder)
    read = read_files(directory, listing(directory, r"^part-[^ ]+\.txt$")).select(F.decode("content", "utf-8").alias("text"), "length")
    rows = read.select(F.explode(F.split("text", "\n")).alias("line"), (F.length("text") == F.col("length")).alias("whole"))
    return rows.filter("line <> ''")


# --- headers -----------------------------------------------------------------


def _headers(spark, d):
    """The part table as a header table: brand = file, key = position, name = header."""
    return _table(spark, d, "part").select("p_brand", "p_partkey", "p_name")


def _resolve_headers(spark, d):
    targets = {"first": "Cöld w", "second": "BLUE", "third": "zzz"}
    return resolve_headers(_headers(spark, d), targets, ["p_brand"], "p_name", "p_partkey")


def _resolve_headers_all(spark, d):
    prefixes = ["Cöld w", "cold", "BLUE"]
    return resolve_headers_all(_headers(spark, d), prefixes, ["p_brand"], "p_name", "p_partkey")


def _resolve_targets(spark, d):
    """Every brand with targets of its own: the beginnings of its names, of two lengths."""
    headers = _headers(spark, d)
    cuts = F.array(*[F.concat(F.lit(f"{n}: "), F.left("p_name", F.lit(n))) for n in (6, 10)])
    targets = headers.select("p_brand", F.explode(cuts).alias("target")).distinct()
    targets = targets.select("p_brand", "target", F.upper(F.split("target", ": ", 2)[1]).alias("prefix"))
    found = resolve_targets(headers, targets, ["p_brand"], "p_brand", "p_name", "p_partkey")
    return found.select("p_brand", "target", "p_partkey", "p_name")


def _flag_header(spark, d):
    return resolve_flag(_headers(spark, d), "cold", ["widget", "Gádget"], ["p_brand"], "p_name", "p_partkey")


def _missing_columns(spark, d):
    targets = {"all": "cold", "none": "zzz", "some": "Réd pl"}
    return missing_columns(_headers(spark, d), targets, ["p_brand"], "p_name")


# --- rows and counts ---------------------------------------------------------


def _keyed_orders(spark, d):
    """Orders with blank, missing and tab-only keys, which the table lacks."""
    priority = F.col("o_orderpriority")
    key = (
        F.when(priority == "5-LOW", "   ").when(priority == "4-NOT SPECIFIED", F.lit(None))
        .when(priority == "1-URGENT", "\t").otherwise(priority)
    )
    return _table(spark, d, "orders").select("o_orderkey", key.alias("o_key"), "o_orderstatus")


def _labelled(spark, d):
    """Documents with a text, and their label where there is one: unlabelled = blank flag."""
    docs = drop_blank_keys(_table(spark, d, "documents"), "text").select("doc_id", "source", "lang")
    return docs.join(_table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")


def _nonblank_rows(spark, d):
    return drop_blank_keys(_keyed_orders(spark, d), "o_key").select("o_orderkey", "o_key")


def _canonical_select(spark, d):
    return canonical_rows(_table(spark, d, "documents"), {"column_a": "doc_id", "column_b": "source"})


def _optional_flag(spark, d):
    """Rows of workbooks of which some have a flag column and some do not."""

    def sheets(rows):
        width = 3 if rows[0]["source"] < "src15" else 2
        body = [[r["doc_id"], r["source"], r["toxic"]][:width] for r in rows]
        return {"Données": [["Doc_ID", "Source", "Flag toxic"][:width], *body]}

    spec = replace(_load_spec(), columns={"column_a": "doc_id", "column_b": "source"})
    books = books_of(_labelled(spark, d).select("doc_id", "source", "toxic"), sheets, by="source")
    rows = _parsed(spark, books.withColumnRenamed("source", "feed"), spec)
    return kept_rows(rows, spec).select("column_a", "column_b", "flag", "has_flag")


def _load_stats(spark, d):
    flag = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    return load_stats(_keyed_orders(spark, d).withColumn("flag", flag), "o_key", "flag")


def _flag_summary(spark, d):
    return flag_counts(_labelled(spark, d), "toxic", ["source"])


def _flag_total(spark, d):
    return flag_counts(_labelled(spark, d), "toxic")


def _flag_empty(spark, d):
    """No flag column: 0. No rows kept: 0 as well."""
    orders = _keyed_orders(spark, d).withColumn(
        "o_key", F.when(F.col("o_orderstatus") != "P", F.col("o_key"))
    )
    return load_stats(orders, "o_key", by=["o_orderstatus"])


# --- types --------------------------------------------------------------------


def _as_texts(spark, d):
    """Orders as a sheet gives them, all text, with dates, booleans, mixed and blank columns."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    return _table(spark, d, "orders").select(
        key.cast("string").alias("whole"), price.alias("number"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("day"),
        F.when(F.col("o_orderstatus") == "O", "True").otherwise("False").alias("open"),
        F.when(key == 7, "seven").otherwise(key.cast("string")).alias("mixed"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(key.cast("string")).alias("gaps"),
        F.lpad(key.cast("string"), 9, "0").alias("padded"), F.lit(None).cast("string").alias("blank"),
    )


def _infer_types(spark, d):
    """Types of the orders' columns, and of the events' by kind of event."""
    orders, events = _as_texts(spark, d), _table(spark, d, "events")
    found = infer_types(orders, orders.columns).select(F.lit("orders").alias("feed"), "column", "type")
    texts = events.select("event_type", *[
        F.col(c).cast("string").alias(c) for c in ("event_id", "ts", "user_id", "value")])
    return found.unionByName(infer_types(texts, texts.columns[1:], ["event_type"]).withColumnRenamed("event_type", "feed"))


def _typed_rows(spark, d):
    return with_inferred_types(_as_texts(spark, d), ["whole", "number", "day", "open", "mixed", "gaps", "padded", "blank"])


# --- history -----------------------------------------------------------------


def _user_records(events, before=None):
    """One record per user: the events over 100 so far, stamped with the newest event."""
    seen = events if before is None else events.filter(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    counted = seen.groupBy("user_id").agg(
        F.max("ts").alias("at"), F.count_if(F.col("value") > 100).alias("flagged")
    ).withColumn("path", F.concat(F.lit("/in/user_"), "user_id", F.lit(".xlsx")))
    return history_record(counted, "path", F.col("at"), "flagged", keep=["user_id"])


def _source_records(spark, d):
    counted = flag_counts(_labelled(spark, d), "toxic", ["source"])
    path = F.concat(F.lit("/in/"), "source", F.lit(".xlsx"))
    at = F.lit("2024-02-01 06:30:15").cast("timestamp_ntz")
    return history_record(counted, path, at, "flagged", keep=["source"])


def _history_record(spark, d):
    events = _table(spark, d, "events")
    counted = events.groupBy("event_type").agg(
        F.max("ts").alias("at"), F.count_if(F.col("value") > 100).alias("flagged")
    )
    path = F.concat(F.lit("/in/"), "event_type", F.lit(".xlsx"))
    return history_record(counted, path, F.col("at"), "flagged").select(*RECORD)


def _latest_record(spark, d):
    events = _table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    newest = latest_record(events, ["ts", "event_id"])
    return newest.select("event_id", minute_stamp("ts").alias("stamp"), "event_type", "value")


def _latest_per_source(spark, d):
    events = _table(spark, d, "events").select("event_type", "ts", "event_id", "value")
    newest = latest_per(events, ["event_type"], ["ts", "event_id"])
    return newest.select("event_type", "event_id", minute_stamp("ts").alias("stamp"), "value")


def _gate_batch(spark, d):
    """The state at the end against two earlier runs of the same feeds."""
    events = _table(spark, d, "events")
    history = _user_records(events, "2024-01-15").unionByName(_user_records(events, "2024-01-30"))
    new = _user_records(events)
    passed = change_gate(new, history, ["user_id"], ["recorded_at", "processing_timestamp"])
    return passed.select("user_id", *RECORD)


def _gate_first(spark, d):
    records = _source_records(spark, d)
    history = read_history(spark, "feedwell_no_such_history", records.schema)
    passed = change_gate(records, history, ["source"], ["recorded_at", "processing_timestamp"])
    return passed.select("source", *RECORD)


def _change_gate(spark, d):
    events = _table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    changes = keep_changes(events, ["user_id"], ["ts", "event_id"], ["event_type"])
    return changes.select("user_id", "event_id", "event_type")


def _history_replay(spark, d):
    daily = _table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("value") > 100).alias("flagged_line_count")
    )
    changes = keep_changes(daily, ["event_type"], ["day"], ["flagged_line_count"])
    return changes.withColumn("day", F.col("day").cast("string"))


def _gate_null(spark, d):
    """Three equal runs whose feeds include NULL: one record each."""
    feed = F.when(F.col("user_id") % 3 > 0, F.col("user_id").cast("string"))
    counted = _table(spark, d, "events").groupBy(feed.alias("feed")).agg(
        F.max("ts").alias("at"), F.count_if(F.col("value") > 100).alias("flagged"))
    new = history_record(counted, F.lit("/in/all.xlsx"), F.col("at"), "flagged", keep=["feed"])
    history = new.limit(0)
    for _ in range(3):
        passed = change_gate(new, history, ["feed"], ["recorded_at", "processing_timestamp"])
        history = history.unionByName(passed)
    return history.select("feed", *RECORD)


# --- sinks -------------------------------------------------------------------


def _current_table(spark, d):
    """Replace a table by one with another schema, then read it."""
    table, path = f"feedwell_current_{uuid4().hex}", shared_folder(spark)
    orders = _keyed_orders(spark, d)
    write_current(orders.select("o_key"), table, path)
    rows = canonical_rows(orders, {"column_a": "o_key", "column_b": "o_orderkey"}, flag="o_orderstatus")
    write_current(drop_blank_keys(rows, "column_a"), table, path)
    return spark.table(table)


def _history_table(spark, d):
    """Three runs, each appending only the feeds whose record changed."""
    table, path = f"feedwell_history_{uuid4().hex}", shared_folder(spark)
    events = _table(spark, d, "events")
    for before in ("2024-01-15", "2024-01-30", None):
        new = _user_records(events, before)
        history = read_history(spark, table, new.schema)
        passed = change_gate(new, history, ["user_id"], ["recorded_at", "processing_timestamp"])
        append_history(passed, table, path)
    return spark.table(table).select("user_id", *RECORD)


# --- workbooks ---------------------------------------------------------------


def _page_books(spark, d):
    """One workbook per page: sheets named after the host and the language."""
    parts = F.split("url", "/")
    pages = _table(spark, d, "pages").select(
        "page_id", parts[2].alias("host"), parts[3].alias("lang"), basename("url").alias("name")
    )

    def sheets(rows):
        (row,) = rows
        named = [["Ｎame", row["name"]], ["x", 1]]
        return {f"Ｍain {row['host']}": [[row["name"]]], f" {row['lang']} ": named, "End": []}

    return books_of(pages, sheets, by="page_id", each_row=True)


def _page_parts(spark, d):
    return read_parts(_page_books(spark, d), ["page_id"], "Ë", header_only=True)


def _workbook_sheets(spark, d):
    parts = _page_parts(spark, d)
    return parts.select(
        "page_id", F.size("sheets").alias("n_sheets"), "sheet_no", "sheet",
        F.array_join(header_texts(shown("formats")), "|").alias("headers"),
    )


def _workbook_headers(spark, d):
    """The chosen sheets' headers as a table, and the first header per target. The table stays: the result reads it."""
    targets = {"name": "NÀME", "four": "4", "five": "5"}
    folder = shared_folder(spark)
    list_headers(_page_parts(spark, d), ["page_id"]).write.parquet(folder)
    return resolve_headers(spark.read.parquet(folder).filter("header is not null"), targets, ["page_id"])


def _missing_headers(spark, d):
    """Targets that workbooks lack; those of some languages have no header at all."""
    targets = {"name": "NÀME", "four": "4"}
    return missing_columns(list_headers(_page_parts(spark, d), ["page_id"]), targets, ["page_id"])


def _decode_cells(spark, d):
    """Orders as stored cells: long numbers, dates, elapsed times, booleans, errors, text."""
    def cell(at, kind, style, raw):
        stored = F.struct(F.lit(kind).alias("kind"), F.lit(style).alias("style"), raw.cast("string").alias("raw"))
        return F.lit(at).cast("long"), stored

    cells = F.create_map(
        *cell(0, "n", 0, F.lit(-9007199254740993) - F.col("o_orderkey")),
        *cell(1, "n", 2, F.datediff("o_orderdate", F.lit("1899-12-30"))),
        *cell(2, "b", 0, F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)),
        *cell(3, "e", 0, F.lit("#N/A")), *cell(4, "inlineStr", 0, F.col("o_orderpriority")),
        *cell(5, "n", 1, F.col("o_totalprice")), *cell(6, "n", 3, F.col("o_orderkey") % 97 * 0.25),
    )
    parts = _table(spark, d, "orders").select(
        "o_orderkey", F.lit(0).alias("sheet_no"), F.lit(False).alias("date1904"),
        F.array(*map(F.lit, ("id:0", '0.00" days"', "yyyy\\-mm\\-dd", "[hh]:mm"))).alias("formats"),
        F.array(F.struct(F.lit(1).cast("long").alias("row_no"), cells.alias("cells"))).alias("rows"),
    )
    names = ("whole", "day", "open", "error", "priority", "price", "elapsed")
    rows = decode_cells(parts, ["o_orderkey"])
    return rows.select("o_orderkey", *[F.col("cells")[n].alias(name) for n, name in enumerate(names)])


def _workbook_cells(spark, d):
    """Workbooks with shared strings, date styles, booleans and errors."""
    langs = ["de", "en", "es", "fr"]

    def sheets(rows):
        body = [[
            r["doc_id"], Raw(f'<c t="s"><v>{langs.index(r["lang"])}</v></c>'), Raw(f'<c s="1"><v>{45292 + r["doc_id"] % 100}.5</v></c>'),
            Raw(f'<c t="b"><v>{r["doc_id"] % 2}</v></c>'), Raw('<c t="e"><v>#DIV/0!</v></c>'), -r["doc_id"],
        ] for r in rows]
        return {"Rows": body}, langs, '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>'

    docs = _table(spark, d, "documents").select("doc_id", "lang", "source")
    rows = decode_cells(read_parts(books_of(docs, sheets, by="source"), ["source"], stage=_staying(spark)), ["source"])
    names = ("doc_id", "lang", "day", "odd", "error", "negative")
    return rows.select("source", *[F.col("cells")[n].alias(name) for n, name in enumerate(names)])


def _document_rows(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    return docs.join(_table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")


def _workbook_rows(spark, d):
    def sheets(rows):
        body = [[r["doc_id"], None, r["text"], r["toxic"]] for r in rows]
        return {"Intro": [["nothing"]], "Rows": [["id", None, "text", "flag"], *body]}

    parts = read_parts(books_of(_document_rows(spark, d), sheets, by="source"), ["source"], "röws", stage=_staying(spark))
    rows = decode_cells(parts, ["source"]).filter(F.col("row_no") > 0)
    cells = F.col("cells")
    return rows.select("source", cells[0].alias("column_a"), F.md5(cells[2]).alias("text_md5"), cells[3].alias("flag"))


def _load_spec():
    return FeedSpec(
        name_regex=r"^[^ ]+\.xlsx$", sheet_prefix="données", columns={"column_a": "doc_id", "column_b": "lang"},
        key="column_a", flag_prefix="flag", flag_markers=("toxic", "other"),
    )


def _load_books(docs, by):
    """Workbooks with drifting headers; the key is spaces in German rows, missing in Spanish ones."""
    blank = {"de": "  ", "es": None}
    drift = {"src1": "  DOC_ID (new)", "src2": "Döc_id", "src3_en": "ｄｏｃ_id"}

    def sheets(rows):
        header = ["n", "Läng", drift.get(rows[0][by], "Doc_ID"), "Flag - Tóxic"]
        body = [[i, r["lang"], blank.get(r["lang"], r["doc_id"]), r["toxic"]] for i, r in enumerate(rows)]
        return {"Intro": [["nothing"]], "DONNEES 2024": [header, *body]}

    return books_of(docs, sheets, by)


def _source_books(spark, d):
    docs = _document_rows(spark, d).select("doc_id", F.col("source").alias("feed"), "lang", "toxic")
    return _load_books(docs, "feed")


def _parsed(spark, books, spec):
    """The rows of workbooks, written once as a job does. They stay: the result reads them."""
    folder = shared_folder(spark)
    with staging(spark) as stage:
        sheet_rows(books, spec, stage).write.parquet(folder)
    return spark.read.parquet(folder)


def _staying(spark):
    """A stage whose copies stay, as the result reads them."""

    def stage(df):
        folder = shared_folder(spark)
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    return stage


def _workbook_load(spark, d):
    rows = _parsed(spark, _source_books(spark, d), _load_spec())
    return kept_rows(rows, _load_spec()).select("feed", "column_a", "column_b", "flag", "has_flag")


def _workbook_counts(spark, d):
    counts = feed_counts(_parsed(spark, _source_books(spark, d), _load_spec()), _load_spec())
    return counts.groupBy("feed").agg(
        *[F.sum(c).alias(c) for c in ("rows_read", "rows_kept", "flagged")]
    )


def _workbook_rejects(spark, d):
    spec = FeedSpec(
        name_regex=r".*", sheet_prefix="Ë", columns={"name": "name", "number": "４"}, key="name",
        flag_prefix="flag", flag_markers=("toxic",),
    )
    books = _page_books(spark, d).withColumn("feed", F.col("page_id").cast("string"))
    return rejects(sheet_rows(books, spec, _staying(spark))).select("feed", "reason")


def _jobs(spark, d, runs, keep):
    """The whole job once per run, each a function of the labelled documents that gives workbooks.

    Gives the table named by ``keep``; the other tables of the job are dropped.
    """
    name = f"feedwell_{uuid4().hex}"
    tables = {t: f"{name}_{t}" for t in ("current", "history", "rejects")}
    spec = replace(_load_spec(), feed=lambda name: F.substring_index(name, ".", 1))
    docs = _table(spark, d, "documents").join(_table(spark, d, "labels"), "doc_id", "left")
    with staging(spark) as stage:
        for run, books in enumerate(runs):
            # The books lie on storage, as files do, before the job reads them: no task has a worker that writes and one that reads.
            ingest_loaded(
                stage(books(docs)), spec, tables["current"], tables["history"], tables["rejects"],
                recorded_at=datetime(2024, 2, 1, 6, run),
            )
    for table in set(tables) - {keep}:
        spark.sql(f"drop table {tables[table]}")
    return spark.table(tables[keep])


def _flagged_books(flag):
    def books(docs):
        rows = docs.select("doc_id", F.concat_ws("_", "source", "lang").alias("feed"), "lang", flag.alias("toxic"))
        return _load_books(rows, "feed")

    return books


def _ingest_current(spark, d):
    """The current table after one run over workbooks of all documents."""
    current = _jobs(spark, d, [_flagged_books(F.col("toxic"))], "current")
    return current.select("feed", "column_a", "column_b", "flag", "has_flag")


def _ingest_history(spark, d):
    """The history after two runs: flags of the good documents, then all flags."""
    flags = [F.when(F.col("quality") == 1, F.col("toxic")), F.col("toxic")]
    return _jobs(spark, d, map(_flagged_books, flags), "history").select("feed", *RECORD)


def _ingest_replaced(spark, d):
    """The current table after a second run, with other flags, in which the English feeds are damaged."""

    def damaged(docs):
        books = _flagged_books(F.col("quality"))(docs)
        junk = F.when(F.col("feed").endswith("_en"), F.lit(b"junk")).otherwise(F.col("content"))
        return books.withColumn("content", junk)

    current = _jobs(spark, d, [_flagged_books(F.col("toxic")), damaged], "current")
    return current.select("feed", "column_a", "column_b", "flag", "has_flag")


# --- registry ----------------------------------------------------------------

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalise_key": _normalise_key,
    "normalise_substring": _normalise_substring,
    "path_filter": _path_filter,
    "basename": _basename,
    "minute_stamp": _minute_stamp,
    "candidate_count": _candidate_count,
    "latest_file": _latest_file,
    "latest_files": _latest_files,
    "file_lines": _file_lines,
    "resolve_headers": _resolve_headers,
    "resolve_headers_all": _resolve_headers_all,
    "resolve_targets": _resolve_targets,
    "flag_header": _flag_header,
    "missing_columns": _missing_columns,
    "nonblank_rows": _nonblank_rows,
    "canonical_select": _canonical_select,
    "optional_flag": _optional_flag,
    "load_stats": _load_stats,
    "flag_summary": _flag_summary,
    "flag_total": _flag_total,
    "flag_empty": _flag_empty,
    "infer_types": _infer_types,
    "typed_rows": _typed_rows,
    "history_record": _history_record,
    "latest_record": _latest_record,
    "latest_per_source": _latest_per_source,
    "change_gate_batch": _gate_batch,
    "change_gate_first": _gate_first,
    "change_gate_null": _gate_null,
    "change_gate": _change_gate,
    "history_replay": _history_replay,
    "current_table": _current_table,
    "history_table": _history_table,
    "workbook_sheets": _workbook_sheets,
    "workbook_headers": _workbook_headers,
    "missing_headers": _missing_headers,
    "decode_cells": _decode_cells,
    "workbook_cells": _workbook_cells,
    "workbook_rows": _workbook_rows,
    "workbook_load": _workbook_load,
    "workbook_counts": _workbook_counts,
    "workbook_rejects": _workbook_rejects,
    "ingest_current": _ingest_current,
    "ingest_history": _ingest_history,
    "ingest_replaced": _ingest_replaced,
}


def _optional(registry: str) -> dict:
    """What the operators for training data register under this name; nothing when they, or what they need, are not there."""
    try:
        import corpus_pipeline
        from feedwell.llm import queries as llm
    except ImportError:
        return {}
    found = dict(getattr(llm, registry))
    if registry == "QUERIES":
        found["pipeline"] = corpus_pipeline.run
    elif corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _with_folder(query: Callable) -> Callable:
    """The query in a session that names a shared folder: a temporary one where a local session names none."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and re.match(r"local(\[|$)", context.master):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="feedwell-"))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query, by name; each takes (spark, sf_dir)."""
    return {name: _with_folder(query) for name, query in (_QUERIES | _optional("QUERIES")).items()}


# --- the same in SQL ---------------------------------------------------------


def _base(c: str) -> str:
    return rf"lower(regexp_replace(strip_accents({c}), '[^\x00-\x7F]', '', 'g'))"


def _key(c: str) -> str:
    return rf"regexp_replace({_base(c)}, '[\s\x0b\x1c-\x1f]+', '', 'g')"


_KEYED_ORDERS = r"""
    select o_orderkey, o_orderstatus, case o_orderpriority
        when '5-LOW' then '   ' when '4-NOT SPECIFIED' then null when '1-URGENT' then chr(9)
        else o_orderpriority end as o_key
    from orders"""

_LABELLED = """
    select doc_id, source, lang, toxic from documents left join labels using (doc_id)
    where text is not null and trim(text) <> ''"""

_HEADERS = f"(select p_brand, p_partkey, p_name, {_key('p_name')} as k from part)"


_LISTING = r"""
    select event_type as feed, ts, strftime(ts, '%Y-%m-%d %H:%M') as stamp, user_id as length,
        '/in/' || event_type || '_' || event_id || '.xlsx' as path
    from events where value > 100"""


def _user_sql(before: str | None) -> str:
    when = "" if before is None else f"where ts < timestamp '{before}'"
    return f"""
        select user_id, 'user_' || user_id || '.xlsx' as filename, max(ts) as newest,
            strftime(max(ts), '%Y-%m-%d %H:%M') as processing_timestamp,
            count(case when value > 100 then 1 end) as flagged_line_count
        from events {when} group by user_id"""


_RUNS = f"""
    select 1 as run, * from ({_user_sql('2024-01-15')})
    union all select 2, * from ({_user_sql('2024-01-30')})
    union all select 3, * from ({_user_sql(None)})"""

_PAGES = r"""
    select page_id, split_part(url, '/', 3) as host, split_part(url, '/', 4) as lang,
        regexp_extract(url, '[^/]*$') as name
    from pages"""

_LOADED = f"""
    select source as feed, lang, toxic, quality,
        case lang when 'de' then '  ' when 'es' then null else cast(doc_id as varchar) end as doc_key
    from documents left join labels using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query that it can express."""
    return _SQL | _optional("ORACLE_SQL")


_SQL = {
    "normalise_key": f"select doc_id, md5({_key('text')}) as key_md5 from documents",
    "normalise_substring": f"select doc_id, md5(replace({_base('text')}, ' ', '')) as key_md5 from documents",
    "path_filter": r"""
        select page_id, url from pages
        where regexp_matches(regexp_extract(url, '[^/]*$'), '^[^ ]+\.html$')""",
    "basename": "select page_id, regexp_extract(url, '[^/]*$') as name from pages",
    "minute_stamp": "select event_id, strftime(ts, '%Y-%m-%d %H:%M') as stamp from events",
    "candidate_count": f"select feed, count(*) as files from ({_LISTING}) group by feed",
    "latest_file": f"select path, stamp, length from ({_LISTING}) order by ts desc, path desc limit 1",
    "latest_files": f"""
        select feed, path, stamp, length from ({_LISTING})
        qualify row_number() over (partition by feed order by ts desc, path desc) = 1""",
    "resolve_headers": f"""
        select p_brand, target, min(p_partkey) as p_partkey, arg_min(p_name, p_partkey) as p_name
        from {_HEADERS} h
        join (values ('first', 'coldw'), ('second', 'blue'), ('third', 'zzz')) t(target, prefix)
            on starts_with(k, prefix)
        group by all""",
    "resolve_headers_all": f"""
        select p_brand, p_name, cast(min(target_no) as integer) as target_no, min(p_partkey) as p_partkey
        from {_HEADERS} h
        join (values (0, 'coldw'), (1, 'cold'), (2, 'blue')) t(target_no, prefix) on starts_with(k, prefix)
        group by p_brand, p_name""",
    "resolve_targets": f"""
        with targets as (
            select distinct p_brand, n, n || ': ' || left(p_name, n) as target, {_key('left(p_name, n)')} as prefix
            from part, (values (6), (10)) t(n))
        select p_brand, target, min(p_partkey) as p_partkey, arg_min(p_name, p_partkey) as p_name
        from {_HEADERS} h join targets using (p_brand) where starts_with(k, prefix)
        group by p_brand, target""",
    "flag_header": f"""
        select p_brand, min(p_partkey) as p_partkey, arg_min(p_name, p_partkey) as p_name
        from {_HEADERS} h
        where starts_with(k, 'cold') and (p_name like '%widget%' or p_name like '%gadget%')
        group by p_brand""",
    "missing_columns": f"""
        select p_brand, target
        from (select distinct p_brand from part) part
        cross join (values ('all', 'cold'), ('none', 'zzz'), ('some', 'redpl')) t(target, prefix)
        where not exists (
            select 1 from {_HEADERS} h
            where h.p_brand = part.p_brand and starts_with(h.k, t.prefix))""",
    "nonblank_rows": f"""
        select o_orderkey, o_key from ({_KEYED_ORDERS})
        where o_key is not null and trim(o_key) <> ''""",
    "canonical_select": """
        select cast(doc_id as varchar) as column_a, source as column_b, cast(null as varchar) as flag,
            false as has_flag
        from documents""",
    "optional_flag": f"""
        select cast(doc_id as varchar) as column_a, source as column_b,
            case when source < 'src15' then cast(toxic as varchar) end as flag, source < 'src15' as has_flag
        from ({_LABELLED})""",
    "load_stats": f"""
        select count(*) as rows_read, count(*) filter (trim(o_key) <> '') as rows_kept,
            count(case when o_orderstatus <> 'O' then 1 end) filter (trim(o_key) <> '') as flagged
        from ({_KEYED_ORDERS})""",
    "flag_summary": f"""
        select source, count(*) as rows_kept, count(toxic) as flagged from ({_LABELLED}) group by source""",
    "flag_total": f"select count(*) as rows_kept, count(toxic) as flagged from ({_LABELLED})",
    "flag_empty": f"""
        select o_orderstatus, count(*) as rows_read,
            count(*) filter (trim(o_key) <> '' and o_orderstatus <> 'P') as rows_kept,
            cast(0 as bigint) as flagged
        from ({_KEYED_ORDERS}) group by o_orderstatus""",
    "infer_types": r"""
        with cells as (
            select 'orders' as feed, unnest([
                {'c': 'whole', 'v': cast(o_orderkey as varchar)}, {'c': 'number', 'v': cast(o_totalprice as varchar)},
                {'c': 'day', 'v': strftime(o_orderdate, '%Y-%m-%d 00:00:00')},
                {'c': 'open', 'v': case when o_orderstatus = 'O' then 'True' else 'False' end},
                {'c': 'mixed', 'v': case when o_orderkey = 7 then 'seven' else cast(o_orderkey as varchar) end},
                {'c': 'gaps', 'v': case when o_orderkey % 3 > 0 then cast(o_orderkey as varchar) end},
                {'c': 'padded', 'v': lpad(cast(o_orderkey as varchar), 9, '0')}, {'c': 'blank', 'v': null}], recursive := true)
            from orders
            union all
            select event_type, unnest([
                {'c': 'event_id', 'v': cast(event_id as varchar)}, {'c': 'ts', 'v': cast(ts as varchar)},
                {'c': 'user_id', 'v': cast(user_id as varchar)}, {'c': 'value', 'v': cast(value as varchar)}], recursive := true)
            from events)
        select feed, c as column, case when count(v) = 0 then 'string'
            when bool_and(v in ('True', 'False')) filter (v is not null) then 'boolean'
            when bool_and(try_cast(v as bigint) is not null and regexp_full_match(v, '0|-?[1-9][0-9]*')) filter (v is not null) then 'bigint'
            when bool_and(try_cast(v as double) is not null and regexp_full_match(v, '-?(0|[1-9][0-9]*)([.][0-9]+)?(e[+-]?[0-9]+)?')) filter (v is not null) then 'double'
            when bool_and(try_cast(v as timestamp) is not null and (length(v) = 10 or v like '% 00:00:00')) filter (v is not null) then 'date'
            when bool_and(try_cast(v as timestamp) is not null) filter (v is not null) then 'timestamp_ntz' else 'string' end as type
        from cells group by feed, c""",
    "typed_rows": """
        select o_orderkey as whole, o_totalprice as number, cast(o_orderdate as date) as day, o_orderstatus = 'O' as open,
            case when o_orderkey = 7 then 'seven' else cast(o_orderkey as varchar) end as mixed,
            case when o_orderkey % 3 > 0 then o_orderkey end as gaps, lpad(cast(o_orderkey as varchar), 9, '0') as padded,
            cast(null as varchar) as blank
        from orders""",
    "history_record": """
        select event_type || '.xlsx' as filename, strftime(max(ts), '%Y-%m-%d %H:%M') as processing_timestamp,
            count(case when value > 100 then 1 end) as flagged_line_count
        from events group by event_type""",
    "latest_record": """
        select event_id, strftime(ts, '%Y-%m-%d %H:%M') as stamp, event_type, value
        from events order by ts desc, event_id desc limit 1""",
    "latest_per_source": """
        select event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M') as stamp, value
        from events
        qualify row_number() over (partition by event_type order by ts desc, event_id desc) = 1""",
    "change_gate_batch": f"""
        with runs as ({_RUNS}),
        latest as (
            select * from runs where run < 3
            qualify row_number() over (partition by user_id order by newest desc, run desc) = 1)
        select n.user_id, n.filename, n.processing_timestamp, n.flagged_line_count
        from (select * from runs where run = 3) n left join latest o using (user_id)
        where n.filename is distinct from o.filename
            or n.flagged_line_count is distinct from o.flagged_line_count""",
    "change_gate_first": f"""
        select source, source || '.xlsx' as filename, '2024-02-01 06:30' as processing_timestamp,
            count(toxic) as flagged_line_count
        from ({_LABELLED}) group by source""",
    "change_gate": """
        select user_id, event_id, event_type from events
        qualify event_type is distinct from
            lag(event_type) over (partition by user_id order by ts, event_id)""",
    "history_replay": """
        select event_type, cast(day as varchar) as day, flagged_line_count
        from (select event_type, cast(ts as date) as day,
                  count(case when value > 100 then 1 end) as flagged_line_count
              from events group by all)
        qualify flagged_line_count is distinct from
            lag(flagged_line_count) over (partition by event_type order by day)""",
    "current_table": f"""
        select o_key as column_a, cast(o_orderkey as varchar) as column_b, o_orderstatus as flag,
            true as has_flag
        from ({_KEYED_ORDERS}) where trim(o_key) <> ''""",
    "history_table": f"""
        select user_id, filename, processing_timestamp, flagged_line_count from ({_RUNS})
        qualify flagged_line_count is distinct from
            lag(flagged_line_count) over (partition by user_id order by run)""",
    "workbook_sheets": f"""
        select page_id, 3 as n_sheets, case when lang like 'e%' then 1 else 2 end as sheet_no,
            case when lang like 'e%' then ' ' || lang || ' ' else 'End' end as sheet,
            case when lang not like 'e%' then '' when name = '' then 'Ｎame' else 'Ｎame|' || name end as headers
        from ({_PAGES})""",
    "workbook_headers": f"""
        select page_id, target, cast(ordinal as integer) as ordinal, header from (
            select page_id, 'name' as target, 0 as ordinal, 'Ｎame' as header from ({_PAGES}) where lang like 'e%'
            union all
            select page_id, 'four', 1, name from ({_PAGES}) where lang like 'e%' and name like '4%'
            union all
            select page_id, 'five', 1, name from ({_PAGES}) where lang like 'e%' and name like '5%')""",
    "workbook_rows": """
        select source, cast(doc_id as varchar) as column_a, md5(text) as text_md5,
            cast(toxic as varchar) as flag
        from documents left join labels using (doc_id)""",
    "workbook_load": f"""
        select feed, doc_key as column_a, lang as column_b, cast(toxic as varchar) as flag, true as has_flag
        from ({_LOADED}) where trim(doc_key) <> ''""",
    "workbook_counts": f"""
        select feed, count(*) as rows_read, count(*) filter (trim(doc_key) <> '') as rows_kept,
            count(toxic) filter (trim(doc_key) <> '') as flagged
        from ({_LOADED}) group by feed""",
    "ingest_current": f"""
        select feed || '_' || lang as feed, doc_key as column_a, lang as column_b,
            cast(toxic as varchar) as flag, true as has_flag
        from ({_LOADED}) where trim(doc_key) <> ''""",
    "file_lines": r"""
        select doc_id || '|' || lang || '|' || source as line, true as whole from documents""",
    "change_gate_null": """
        select case when user_id % 3 > 0 then cast(user_id as varchar) end as feed, 'all.xlsx' as filename,
            strftime(max(ts), '%Y-%m-%d %H:%M') as processing_timestamp,
            count(case when value > 100 then 1 end) as flagged_line_count
        from events group by 1""",
    "missing_headers": f"""
        select page_id, target from ({_PAGES}), (values ('name'), ('four')) t(target)
        where lang not like 'e%' or target = 'four' and name not like '4%'""",
    "decode_cells": r"""
        select o_orderkey, cast(-9007199254740993 - o_orderkey as varchar) as whole,
            strftime(o_orderdate, '%Y-%m-%d 00:00:00') as day,
            case when o_orderstatus = 'O' then 'True' else 'False' end as open, cast(null as varchar) as error,
            o_orderpriority as priority,
            case when o_totalprice = floor(o_totalprice) then cast(cast(o_totalprice as bigint) as varchar)
                else cast(o_totalprice as varchar) end as price,
            case when o_orderkey % 97 >= 8 then (o_orderkey % 97 // 4) || ' days, '
                when o_orderkey % 97 >= 4 then '1 day, ' else '' end || (o_orderkey % 97 % 4 * 6) || ':00:00' as elapsed
        from orders""",
    "workbook_cells": r"""
        select source, cast(doc_id as varchar) as doc_id, lang,
            strftime(date '1899-12-30' + cast(45292 + doc_id % 100 as integer), '%Y-%m-%d 12:00:00') as day,
            case when doc_id % 2 = 1 then 'True' else 'False' end as odd, cast(null as varchar) as error,
            cast(-doc_id as varchar) as negative
        from documents""",
    "ingest_replaced": f"""
        select feed || '_' || lang as feed, doc_key as column_a, lang as column_b,
            cast(case when lang = 'en' then toxic else quality end as varchar) as flag, true as has_flag
        from ({_LOADED}) where trim(doc_key) <> ''""",
    "ingest_history": f"""
        with counts as (
            select feed || '_' || lang as feed, count(toxic) filter (trim(doc_key) <> '') as later,
                count(case when quality = 1 then toxic end) filter (trim(doc_key) <> '') as earlier
            from ({_LOADED}) group by all)
        select feed, feed || '.xlsx' as filename, '2024-02-01 06:00' as processing_timestamp,
            earlier as flagged_line_count from counts
        union all
        select feed, feed || '.xlsx', '2024-02-01 06:01', later from counts where later <> earlier""",
    "workbook_rejects": f"""
        select cast(page_id as varchar) as feed,
            case when lang like 'e%'
                then 'no header starts with ''４'' (number); headers: Ｎame'
                    || case when name = '' then '' else ', ' || name end
                else 'no header starts with ''name'' (name); headers: ' end as reason
        from ({_PAGES}) where not (lang like 'e%' and name like '4%')""",
}
