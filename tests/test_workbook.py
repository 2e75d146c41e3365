"""Sheets, headers and cells of workbooks, one test per rule."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from feedwell.operators import decode_cells, header_texts, list_headers, missing_columns, shown
from feedwell.plans import FeedSpec, feed_counts, rejects, sheet_rows
from feedwell.plans.load import kept_rows
from feedwell.sources import ooxml, read_parts, workbook
from feedwell.sources.workbook import PART_ROWS
from feedwell.testing.books import Raw, book_bytes

SPEC = FeedSpec(
    name_regex=r"^FILE_PREFIX_[^ ]+\.xlsx$", sheet_prefix="sheet prefix", columns={"column_a": "column_a", "column_b": "column_b"},
    key="column_a", flag_prefix="flag", flag_markers=("marker1", "marker2"),
)
HEAD = ["Column_A", "Column_B", "Flag (marker1)"]


def loaded(spark, **books):
    rows = [("", name, bytearray(data)) for name, data in books.items()]
    return spark.createDataFrame(rows, "feed string, path string, content binary")


def sheet(*rows, name="Sheet Prefix", **kw):
    return book_bytes({name: rows}, **kw)


def kept(spark, data, spec=SPEC):
    rows = kept_rows(sheet_rows(loaded(spark, x=data), spec), spec)
    return [(r.column_a, r.column_b, r.flag) for r in rows.collect()]


def reason(spark, data, spec=SPEC):
    found = rejects(sheet_rows(loaded(spark, x=data), spec)).collect()
    return found[0].reason if found else None


def decoded(spark, data):
    return decode_cells(read_parts(loaded(spark, x=data), ["path"], "s"), ["path"]).orderBy("row_no").collect()


def cells(spark, data):
    """The cells of each row as a list, None where there is none or an error."""
    return [[r.cells.get(at) for at in range(max(r.cells) + 1)] for r in decoded(spark, data)]


def test_sheet_and_columns_drift(spark):
    plain = book_bytes({"Intro": [["x"]], "Shéet  PREFIX 1": [HEAD, ["k", "v", "y"]]})
    drift = sheet(["  COLUMN_A (new)", "Cölumn_B", "flag - Marker2"], ["k", "v", "y"])
    assert kept(spark, plain) == kept(spark, drift) == [("k", "v", "y")]


def test_sheets_in_order_with_headers(spark):
    data = book_bytes({"B": [["x", None, 3]], "A": [], "Sheet": [[], ["late"]]})
    parts = read_parts(loaded(spark, x=data), ["path"], header_only=True)
    found = parts.select("sheet_no", "sheet", header_texts(shown("formats")).alias("h"), "error").orderBy("sheet_no").collect()
    assert [tuple(r) for r in found] == [(0, "B", ["x", "3"], None), (1, "A", [], None), (2, "Sheet", [], None)]
    spots = list_headers(parts, ["sheet"]).collect()
    assert {tuple(r) for r in spots} == {("B", 0, "x"), ("B", 2, "3"), ("A", None, None), ("Sheet", None, None)}


def test_a_workbook_without_headers_lacks_every_column(spark):
    books = loaded(spark, full=book_bytes({"S": [["Key", "x"]]}), other=book_bytes({"S": [["x"]]}), none=book_bytes({"S": []}))
    headers = list_headers(read_parts(books, ["path"], "s", header_only=True), ["path"])
    found = missing_columns(headers, {"k": "key", "y": "y"}, ["path"]).collect()
    assert {tuple(r) for r in found} == {("full", "y"), ("other", "k"), ("other", "y"), ("none", "k"), ("none", "y")}


def test_first_of_two_matching_sheets(spark):
    data = book_bytes({"Sheet prefix b": [HEAD, ["1", "2", "3"]], "Sheet prefix a": [HEAD, ["4", "5", "6"]]})
    assert kept(spark, data) == [("1", "2", "3")]


def test_no_sheet_no_key_and_no_second_column(spark):
    assert "no sheet" in reason(spark, book_bytes({"Intro": [HEAD]})) and "Intro" in reason(spark, book_bytes({"Intro": [HEAD]}))
    assert "(column_a); headers: Other, Column_B" in reason(spark, sheet(["Other", "Column_B"], ["1", "2"]))
    assert "(column_b)" in reason(spark, sheet(["Column_A"], ["1"]))
    assert "(column_a)" in reason(spark, sheet())


def test_flag_column_is_optional_and_the_first_one_counts(spark):
    none = sheet(["Column_A", "Column_B", "flag"], ["k", "v", "y"])
    rows = sheet_rows(loaded(spark, x=none), SPEC)
    assert [(r.flag, r.has_flag) for r in kept_rows(rows, SPEC).collect()] == [(None, False)]
    assert feed_counts(rows, SPEC).first()[2:] == (1, 1, 0)
    two = sheet([*HEAD[:2], "flag", "Flag marker2", "Flag marker1"], ["k", "v", "0", "1", "2"])
    assert kept(spark, two) == [("k", "v", "1")]
    split = sheet([*HEAD[:2], "Flag mar\tker1"], ["k", "v", "y"])
    assert kept(spark, split) == [("k", "v", None)]


def test_blank_keys_and_flags(spark):
    keys = sheet(HEAD, ["a"], [None, "x"], ["  ", "x"], ["\t", "x"], ["", "x"])
    assert [k for k, *_ in kept(spark, keys)] == ["a", "\t"]
    flags = sheet(HEAD, *[["k", "v", f] for f in ("y", None, 0, "n", "")])
    assert feed_counts(sheet_rows(loaded(spark, x=flags), SPEC), SPEC).first()[2:] == (5, 5, 3)


def test_missing_words_are_a_parameter(spark):
    data = sheet(HEAD, ["NA", "1"], ["None", "2"], ["ok", "n/a"])
    assert kept(spark, data) == [("ok", None, None)]
    words = FeedSpec(**{**SPEC.__dict__, "na_words": ("ok",)})
    assert [k for k, *_ in kept(spark, data, words)] == ["NA", "None"]


def test_header_only_and_blank_rows(spark):
    rows = sheet_rows(loaded(spark, x=sheet(HEAD)), SPEC)
    assert kept_rows(rows, SPEC).collect() == [] and feed_counts(rows, SPEC).first()[2:] == (0, 0, 0)
    gaps = sheet(HEAD, ["a"], [], [None, None, ""], ["b"], [], [""])
    assert feed_counts(sheet_rows(loaded(spark, x=gaps), SPEC), SPEC).first()[2:] == (4, 2, 0)


def test_cells_of_other_columns_keep_a_row(spark):
    empty, full = Raw('<c r="H5" t="s"><v>0</v></c>'), Raw('<c r="H4" t="s"><v>1</v></c>')
    data = sheet(HEAD, ["a"], [None, None, None, None, "x"], [full], [empty], strings=["", "x"])
    assert feed_counts(sheet_rows(loaded(spark, x=data), SPEC), SPEC).first()[2:] == (3, 1, 0)
    beside = sheet(HEAD, ["a", "b", "y", "unused", 5], [empty, full], strings=["", "x"])
    assert feed_counts(sheet_rows(loaded(spark, x=beside), SPEC), SPEC).first()[2:] == (2, 1, 1)


def test_odd_headers_do_not_matter(spark):
    data = sheet(["a.b", "`", "x", "x", None, "COLUMN_A.1", "Column_b`", "column_a"], [1, 2, 3, 4, 5, "k", "v", "z"])
    assert kept(spark, data) == [("k", "v", None)]


def test_cells(spark):
    styles = (
        '<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="[Red]0.00&quot;days&quot;"/>'
        '<numFmt numFmtId="166" formatCode="[hh]:mm"/></numFmts>'
        '<cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/>'
        '<xf numFmtId="22"/><xf numFmtId="166"/><xf numFmtId="46"/></cellXfs>'
    )
    strings = ["zero _x005F_x0041_", "  spaced ", Raw("<si><r><t>ri</t></r><rPh><t>no</t></rPh><r><t>ch</t></r></si>"), ""]
    one = [
        Raw('<c r="A2" t="s"><v>0</v></c>'), Raw('<c t="s"><v>1</v></c>'), Raw('<c r="D2" t="s"><v>2</v></c>'),
        "inline é <&>", Raw('<c t="b"><v>1</v></c>'), Raw('<c t="e"><v>#DIV/0!</v></c>'),
        Raw("<c><f>1+1</f><v>2</v></c>"), Raw('<c t="str"><f>x</f><v>007</v></c>'), 7, 7.5, 1e3, Raw("<c><v>-3</v></c>"),
        Raw('<c t="s"><v>99</v></c>'), Raw("<c><f>1+1</f></c>"), Raw('<c t="s"><v>3</v></c>'), Raw('<c t="d"><v>2024-02-03T04:05:06</v></c>'),
        Raw('<c r="AA2"><v>1.0E+2</v></c>'),
    ]
    two = [Raw(f'<c s="{s}"><v>{v}</v></c>') for s, v in [
        (1, 45292), (2, 2.25), (3, 45292.5), (4, 1.5), (5, 0.25), (1, 0.5), (3, 1), (0, 45292), (3, 59.5), (3, 61), (3, 0),
    ]]
    found = cells(spark, book_bytes({"S": [["h"], one, two]}, strings, styles))
    assert found[1] == [
        "zero _x0041_", "  spaced ", None, "rich", "inline é <&>", "True", None, "2", "007", "7", "7.5", "1000", "-3", None,
        None, None, "2024-02-03 04:05:06", *[None] * 9, "100",
    ]
    assert found[2] == [
        "2024-01-01 00:00:00", "2.25", "2024-01-01 12:00:00", "1 day, 12:00:00", "6:00:00", "12:00:00",
        "1900-01-01 00:00:00", "45292", "1900-02-28 12:00:00", "1900-03-01 00:00:00", "00:00:00",
    ]


def test_the_first_style_is_the_default_and_may_show_dates(spark):
    data = book_bytes({"S": [[45292]]}, styles='<cellXfs><xf numFmtId="14"/></cellXfs>')
    assert cells(spark, data) == [["2024-01-01 00:00:00"]]


def test_1904_calendar(spark):
    styles = '<cellXfs><xf numFmtId="14"/></cellXfs>'
    data = book_bytes({"S": [[Raw('<c s="0"><v>1</v></c>')]]}, styles=styles, options='<workbookPr date1904="1"/>')
    assert cells(spark, data) == [["1904-01-02 00:00:00"]]


def test_row_numbers_with_gaps(spark):
    data = book_bytes({"S": [["h"], Raw('<row r="4"><c r="B4"><v>1</v></c></row>'), ["z"], Raw('<row r="9"/>')]})
    assert [(r.row_no, r.cells) for r in decoded(spark, data)] == [(0, {0: "h"}), (3, {1: "1"}), (4, {0: "z"})]


@pytest.mark.parametrize("raw,text", [
    ("-9007199254740993", "-9007199254740993"), ("9007199254740993", "9007199254740993"), ("-007", "-7"), ("-0", "0"), ("000", "0"),
    ("0.10000000000000001", "0.1"), ("12345678.5", "12345678.5"), ("-0.00012345", "-0.00012345"), ("1.5E-7", "1.5e-07"), ("1E3", "1000"),
    ("1e15", "1000000000000000"), ("123456789012.25", "123456789012.25"), (" 7 ", "7"), ("1e400", None), ("nan", None), ("x", None), ("-2.0", "-2"),
    ("-0.0", "0"), ("1e20", "100000000000000000000"),
])
def test_numbers(spark, raw, text):
    found = decoded(spark, book_bytes({"S": [["h", Raw(f"<c><v>{raw}</v></c>")]]}))
    assert found[0].cells == {0: "h", 1: text}


def test_rows_and_columns_have_no_limit(spark):
    far = Raw('<row r="9999999999"><c r="ZZZZZ1"><v>1</v></c><c r="A1"><v>2</v></c></row>')
    data = sheet(HEAD, ["k", "v", "y"], far)
    rows = sheet_rows(loaded(spark, x=data), SPEC)
    assert kept_rows(rows, SPEC).count() == 2 and feed_counts(rows, SPEC).first()[2:] == (9_999_999_998, 2, 1)


def test_a_prefixed_namespace(spark):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    data = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book_bytes({"S": []}))) as old, zipfile.ZipFile(data, "w") as new:
        for name in old.namelist():
            body = old.read(name).decode()
            if "sheet1" in name:
                body = (
                    f'<x:worksheet xmlns:x="{ns}"><x:sheetData><x:row><x:c t="inlineStr"><x:is><x:t>h</x:t></x:is></x:c>'
                    "</x:row></x:sheetData></x:worksheet>"
                )
            new.writestr(name, body)
    assert cells(spark, data.getvalue()) == [["h"]]


def test_a_damaged_workbook_does_not_stop_the_others(spark):
    good = sheet(HEAD, ["k", "v", "y"])
    broken_xml = sheet(HEAD, *[[str(i), "v", "y"] for i in range(30_000)], [Raw("<c><v>1</c>")])
    books = loaded(spark, good=good, junk=b"not a zip", cut=good[: len(good) // 2], none=b"", late=broken_xml)
    rows = sheet_rows(books, SPEC)
    assert [(r.path, r.column_a) for r in kept_rows(rows, SPEC).collect()] == [("good", "k")]
    found = {r.path: r.reason for r in rejects(rows).collect()}
    assert sorted(found) == ["cut", "junk", "late", "none"]
    assert rows.filter("path = 'late' and reason is null").count() > 0  # not held until its end
    assert found["late"].startswith("unreadable sheet: ") and found["junk"].startswith("unreadable workbook: ")
    assert [r.path for r in feed_counts(rows, SPEC).collect()] == ["good"]


def test_a_long_sheet_comes_in_chunks_and_whole(spark):
    data = sheet(HEAD, *[[i, f"v{i}", "y" if i % 3 == 0 else None] for i in range(25_000)])
    rows = sheet_rows(loaded(spark, x=data), SPEC)
    assert feed_counts(rows, SPEC).first()[2:] == (25_000, 25_000, 8_334)
    assert kept_rows(rows, SPEC).select("column_b").distinct().count() == 25_000


def test_long_cells_come_in_bounded_batches(spark):
    data = sheet(HEAD, *[[i, "x" * 400_000, "y"] for i in range(100)])
    rows = kept_rows(sheet_rows(loaded(spark, x=data, y=data), SPEC), SPEC)
    assert [tuple(r) for r in rows.groupBy("path").agg({"*": "count", "column_b": "max"}).selectExpr(
        "path", "`count(1)`", "length(`max(column_b)`)").orderBy("path").collect()] == [("x", 100, 400_000), ("y", 100, 400_000)]


@pytest.fixture()
def stage(spark, tmp_path):
    """Keeps each staged table, in order."""
    kept = []

    def write(df):
        df.write.parquet(f"{tmp_path}/{len(kept)}")
        kept.append(spark.read.schema(df.schema).parquet(f"{tmp_path}/{len(kept)}"))
        return kept[-1]

    write.kept = kept
    return write


def test_bytes_are_opened_once_and_cells_decoded_by_spark(spark, stage):
    plan = sheet_rows(loaded(spark, x=sheet(HEAD)), SPEC, stage)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan  # blocks and cells are staged
    lazy = sheet_rows(loaded(spark, x=sheet(HEAD)), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in lazy and "CartesianProduct" not in lazy and "NestedLoop" not in lazy


@pytest.mark.parametrize("staged", [False, True])
def test_small_blocks_give_the_same_answers(spark, stage, monkeypatch, staged):
    rows = [[i if i % 5 else None, Raw(f'<c t="s"><v>{i % 9}</v></c>'), "y" if i % 3 else None] for i in range(700)]
    rows[300] = Raw('<row r="500"><c><v>7</v></c></row>')  # numbers go on from there
    data = sheet(HEAD, *rows, strings=[f"text {n}" for n in range(7)] + [""])
    books = loaded(spark, a=data, b=data, c=sheet(HEAD, ["k", "v", "y"]))

    def answers():
        found = sheet_rows(books, SPEC, stage if staged else None)
        return sorted(map(tuple, kept_rows(found, SPEC).collect()), key=repr), sorted(map(tuple, feed_counts(found, SPEC).collect()))

    whole = answers()
    blocks, parts = (t.count() for t in stage.kept) if staged else (0, 0)
    for size in (1, 3_000):
        monkeypatch.setattr(ooxml, "BLOCK_BYTES", size)
        assert answers() == whole
    if staged:
        assert (blocks, parts) == (5, 3) and stage.kept[2].count() > 1_400
    kept_a = [r for r in whole[0] if r[1] == "a"]
    assert len(kept_a) == 561 and {r[3] for r in kept_a} == {f"text {n}" for n in range(7)} | {None}


def test_a_sheet_of_two_million_rows_is_read_by_many_tasks(spark, stage):
    size = 2_000_000
    body = "".join(f'<row><c><v>{n}</v></c><c t="s"><v>{n % 3}</v></c></row>' for n in range(size))
    head = "<row><c t='inlineStr'><is><t>Column_A</t></is></c><c t='inlineStr'><is><t>Column_B</t></is></c></row>"
    data = book_bytes({"Sheet prefix": [Raw(head + body)]}, strings=["x", "y", "z"])
    rows = sheet_rows(loaded(spark, x=data), SPEC, stage)
    blocks = stage.kept[0].filter("part_no >= 0")
    assert blocks.count() > 40 and blocks.agg({"size": "max"}).first()[0] < 3 * ooxml.BLOCK_BYTES
    assert workbook._dealt(blocks, True).rdd.getNumPartitions() >= blocks.count()
    found = kept_rows(rows, SPEC).groupBy("column_b").agg({"*": "count", "column_a": "max"}).collect()
    assert sorted(tuple(r)[:2] for r in found) == [("x", 666_667), ("y", 666_667), ("z", 666_666)]
    # Every task read a share of the rows, not one of them all.
    files = stage.kept[1].groupBy("_metadata.file_path").agg(F.sum(F.size("rows")).alias("n")).collect()
    assert sum(r.n for r in files) == size + 1 and max(r.n for r in files) < size / 10


def test_shared_strings_are_joined_as_a_table(spark, stage):
    many = [f"string {n} " + "x" * 100 for n in range(200_000)]
    rows = [["k", Raw(f'<c t="s"><v>{n}</v></c>'), None] for n in (5, 199_999, 77_777, 200_000, 5)] + [["k", Raw('<c t="s"><v>-1</v></c>')]]
    data = sheet(HEAD, *rows, strings=many)
    found = sheet_rows(loaded(spark, x=data, same=data), SPEC, stage)
    texts = sorted((r.column_b or "") for r in kept_rows(found, SPEC).collect())
    assert texts == sorted(2 * [many[5], many[199_999], many[77_777], "", many[5], ""])
    blocks, parts = stage.kept
    strings = blocks.filter("part_no = -1")
    assert strings.count() > 20 and strings.agg({"size": "max"}).first()[0] < 3 * ooxml.BLOCK_BYTES
    assert [list(r.wanted) for r in parts.select("wanted").distinct().collect()] == [[5, 77_777, 199_999, 200_000]]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "number" in plan


def test_damaged_shared_strings_make_a_reject(spark):
    broken = Raw("<si><t>a</x></si>")
    books = loaded(
        spark, bad=sheet(HEAD, [Raw('<c t="s"><v>0</v></c>'), "v"], strings=[broken]), unused=sheet(HEAD, ["k", "v"], strings=[broken]),
        good=sheet(HEAD, [Raw('<c t="s"><v>0</v></c>'), "v"], strings=["k"]))
    rows = sheet_rows(books, SPEC)
    assert [(r.path, "shared strings" in r.reason) for r in rejects(rows).collect()] == [("bad", True)]
    assert sorted(r.path for r in kept_rows(rows, SPEC).collect()) == ["good", "unused"]


def test_several_damaged_blocks_make_one_reject(spark, monkeypatch):
    monkeypatch.setattr(ooxml, "BLOCK_BYTES", 200)
    rows = [[str(n), "v", "y" if n % 20 else Raw("<c><v>1</c>")] for n in range(100)]
    found = rejects(sheet_rows(loaded(spark, x=sheet(HEAD, *rows)), SPEC)).collect()
    assert [(r.path, r.reason.startswith("unreadable sheet: ")) for r in found] == [("x", True)]


def test_only_wanted_columns_leave_the_reader(spark):
    data = sheet(["Column_A", "Other", 7], *[["k", "x" * 10, 1]] * (PART_ROWS + 1), ["", "only"])
    parts = read_parts(loaded(spark, x=data), ["path"], "sheet", columns=["column_a"]).orderBy("part_no").collect()
    assert [p.part_no for p in parts] == [0, 1] and all(len(p.head) == 3 for p in parts)
    last = [r for p in parts for r in p.rows][-2:]
    assert [sorted(r.cells) for r in last] == [[0, 2], []] and last[-1].row_no == PART_ROWS + 2


@pytest.mark.parametrize("change", [
    {"sheet_prefix": " "}, {"columns": {"column_a": "ß"}}, {"flag_prefix": ""}, {"flag_markers": ()},
    {"flag_markers": ("",)}, {"key": "other"},
])
def test_a_spec_that_would_match_everything_is_refused(change):
    with pytest.raises(ValueError):
        FeedSpec(**{**SPEC.__dict__, **change})
