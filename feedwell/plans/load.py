"""From workbook bytes to canonical rows, rejects and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwell.functions.cells import missing_to_null
from feedwell.functions.names import ascii_key, ascii_marker
from feedwell.operators.cells import cell_text, header_texts, shown
from feedwell.operators.headers import first_position, flag_position
from feedwell.operators.rows import canonical_rows, drop_blank_keys
from feedwell.operators.stats import load_stats
from feedwell.plans.spec import FeedSpec
from feedwell.sources.workbook import Stage, read_parts


def sheet_rows(loaded: DataFrame, spec: FeedSpec, stage: Stage | None = None) -> DataFrame:
    """All rows of the chosen sheet of every workbook in ``loaded`` (path, content, feed).

    Gives (feed, path, reason, row_no, the canonical columns, flag, has_flag). Blank rows are left
    out, but row 0, the header row, is always there, so that every workbook has a row. A workbook
    that cannot be loaded has rows with ``reason`` set; where the damage shows part way, it has others
    too, which ``kept_rows`` and ``feed_counts`` drop. Columns are chosen from the header that each
    part of a sheet carries. ``stage`` is that of ``read_parts``.
    """
    parts = read_parts(
        loaded.select("feed", "path", "content"), ["feed", "path"], spec.sheet_prefix,
        columns=[*spec.columns.values(), spec.flag_prefix], stage=stage,
    )
    parts = parts.withColumn("__styles", shown("formats")).withColumn("__headers", header_texts(F.col("__styles")))
    names = F.zip_with("head", "__headers", lambda h, t: F.coalesce(h["plain"], t))
    parts = parts.withColumns({
        "__keys": F.transform(names, ascii_key), "__marks": F.transform(names, ascii_marker),
    })
    places = {f"__at_{i}": first_position(F.col("__keys"), p) for i, p in enumerate(spec.columns.values())}
    flag = flag_position(F.col("__keys"), F.col("__marks"), spec.flag_prefix, spec.flag_markers)
    places["__at_flag"] = flag
    parts = parts.withColumns({at: F.get("head", place)["at"] for at, place in places.items()})
    parts = parts.withColumn("reason", _reason(spec, [*places][:-1]))
    # One row of a reject, whatever the number of its parts; row 0 where the sheet has none.
    first = F.col("part_no") == 0
    row0 = F.expr("array(named_struct('row_no', 0L, 'cells', cast(null as map<bigint, struct<kind:string,style:int,raw:string>>)))")
    none = F.slice("rows", 1, 0)
    broken = F.col("error").isNotNull()
    rows = F.when(F.col("reason").isNotNull(), F.when(first | broken, row0).otherwise(none)).when(
        first & ((F.size("rows") == 0) | (F.get("rows", F.lit(0))["row_no"] > 0)), F.concat(row0, "rows")).otherwise(F.col("rows"))
    carried = ["feed", "path", "reason", "date1904", "__styles", *places]
    read = parts.select(*carried, F.inline(rows))

    cells = F.array(*[F.when(F.col(at).isNotNull(), F.try_element_at("cells", F.col(at))) for at in places])
    texts = F.transform(cells, lambda c: missing_to_null(
        cell_text(c, F.col("__styles"), F.col("date1904")), spec.na_words))
    read = read.select("feed", "path", "reason", "row_no", "__at_flag", texts.alias("__texts"))
    *chosen, flag = [F.col("__texts")[n] for n in range(len(places))]
    has_flag = F.col("__at_flag").isNotNull() & F.col("reason").isNull()
    return canonical_rows(
        read, dict(zip(spec.columns, chosen)), flag, keep=("feed", "path", "reason", "row_no"), has_flag=has_flag)


def _reason(spec: FeedSpec, places: list[str]) -> Column:
    """Why a workbook cannot be loaded; NULL when it can."""
    sheets = F.array_join("sheets", ", ")
    checks = [
        (F.col("error").isNotNull(), "", F.col("error")),
        (F.col("sheet_no").isNull(), f"no sheet starts with {spec.sheet_prefix!r}; sheets: ", sheets),
    ] + [
        (F.col(at).isNull(), f"no header starts with {prefix!r} ({name}); headers: ", F.array_join("__headers", ", "))
        for at, (name, prefix) in zip(places, spec.columns.items())
    ]
    first, *others = checks
    start = F.when(first[0], F.concat(F.lit(first[1]), first[2]))
    return reduce(lambda w, c: w.when(c[0], F.concat(F.lit(c[1]), c[2])), others, start)


def _sound(rows: DataFrame) -> DataFrame:
    """Rows of the workbooks that could be loaded to their end."""
    return rows.join(rejects(rows).select("path").distinct(), "path", "left_anti")


def kept_rows(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """Data rows whose key is not blank, as the current table holds them."""
    data = drop_blank_keys(_sound(rows).filter(F.col("row_no") > 0), spec.key)
    return data.select("feed", "path", *spec.columns, "flag", "has_flag")


def rejects(rows: DataFrame) -> DataFrame:
    """(feed, path, reason) of the workbooks that could not be loaded; of several reasons the least."""
    found = rows.filter(F.col("reason").isNotNull()).groupBy("feed", "path")
    return found.agg(F.array_min(F.collect_set("reason")).alias("reason"))


def feed_counts(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows read, rows kept and flags set per loaded workbook; 0 where it has no rows."""
    return load_stats(_sound(rows), spec.key, "flag", ["feed", "path"], row_no="row_no")
