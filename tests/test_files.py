"""Directory listing, newest file, reading bytes."""

import os

import pytest
from pyspark.sql import functions as F

from feedwell.sources import (
    count_files, files, latest_files, list_files, listing, newest_first, open_directory, read_file, read_files,
)

NAMES = r"^FILE_PREFIX_[^ ]+\.xlsx$"


def put(folder, name, when, data=b"x"):
    path = folder / name
    path.write_bytes(data)
    os.utime(path, (when, when))


@pytest.fixture()
def folder(tmp_path):
    for i, name in enumerate([
        "FILE_PREFIX_1.xlsx", "FILE_PREFIX_2.xlsx", "FILE_PREFIX_a b.xlsx", "other.xlsx", "FILE_PREFIX_3.xls",
        "FILE_PREFIX_.xlsx", "file_prefix_4.xlsx", "FILE_PREFIX_5xlsx",
    ]):
        put(tmp_path, name, 1_700_000_000 + i)
    inner = tmp_path / "FILE_PREFIX_dir"
    inner.mkdir()
    put(inner, "FILE_PREFIX_9.xlsx", 1_800_000_000)
    return tmp_path


def names(df):
    return [os.path.basename(r.path) for r in df.collect()]


def test_listing_matches_names_and_is_not_recursive(spark, folder):
    assert sorted(names(list_files(spark, str(folder), NAMES))) == ["FILE_PREFIX_1.xlsx", "FILE_PREFIX_2.xlsx"]
    assert len(names(list_files(spark, str(folder)))) == 8
    assert names(list_files(spark, str(folder), NAMES, glob="*_1.xlsx")) == ["FILE_PREFIX_1.xlsx"]


def test_listing_does_not_read_contents(spark, folder):
    plan = list_files(spark, str(folder), NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_newest_file(spark, folder):
    files = list_files(spark, str(folder), NAMES)
    assert names(latest_files(files)) == ["FILE_PREFIX_2.xlsx"]
    assert names(newest_first(files)) == ["FILE_PREFIX_2.xlsx", "FILE_PREFIX_1.xlsx"]


def test_equal_times_go_to_the_greater_path(spark, tmp_path):
    put(tmp_path, "a.xlsx", 1_700_000_000)
    put(tmp_path, "b.xlsx", 1_700_000_000)
    assert names(latest_files(list_files(spark, str(tmp_path)))) == ["b.xlsx"]


def test_newest_file_of_each_feed(spark, tmp_path):
    for i, name in enumerate(["north_1.xlsx", "south_1.xlsx", "north_2.xlsx"]):
        put(tmp_path, name, 1_700_000_000 + i)
    feed = F.regexp_extract("path", r"([a-z]+)_[^/]*$", 1)
    found = latest_files(list_files(spark, str(tmp_path)), feed).collect()
    assert sorted((r.feed, os.path.basename(r.path)) for r in found) == [
        ("north", "north_2.xlsx"), ("south", "south_1.xlsx"),
    ]


def test_empty_directory_gives_no_rows_and_a_missing_one_raises(spark, tmp_path):
    assert names(latest_files(list_files(spark, str(tmp_path), NAMES))) == []
    opened = open_directory(spark, str(tmp_path))
    assert read_files(opened, listing(opened)).collect() == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        list_files(spark, str(tmp_path / "none")).collect()


def test_reads_only_the_chosen_files_with_odd_names(spark, tmp_path):
    odd = ["a[1].xlsx", "a{b,c}.xlsx", "q?.xlsx", "s*.xlsx", "per%20cent.xlsx", "sp ace.xlsx"]
    for name in [*odd, "a1.xlsx", "ab.xlsx", "qq.xlsx", "star.xlsx"]:
        put(tmp_path, name, 1_700_000_000, name.encode())
    opened = open_directory(spark, str(tmp_path))
    chosen = listing(opened).filter(F.element_at(F.split("path", "/"), -1).isin(odd))
    found = read_files(opened, chosen).collect()
    assert sorted(bytes(r.content).decode() for r in found) == sorted(odd)


def test_one_file(spark, tmp_path):
    put(tmp_path, "x[1].xlsx", 1_700_000_000, b"abc")
    put(tmp_path, "empty.xlsx", 1_700_000_000, b"")
    assert bytes(read_file(spark, str(tmp_path / "x[1].xlsx")).first().content) == b"abc"
    inner = tmp_path / "folder"
    inner.mkdir()
    put(inner, "a.xlsx", 1_700_000_000, b"a")
    for name in ["empty.xlsx", "none.xlsx", "folder", "folder/", "*.xlsx"]:
        with pytest.raises(FileNotFoundError):
            read_file(spark, str(tmp_path / name))


def test_counts(spark, tmp_path):
    for name in ["north_1.xlsx", "south_1.xlsx", "north_2.xlsx"]:
        put(tmp_path, name, 1_700_000_000)
    files = list_files(spark, str(tmp_path))
    feed = F.regexp_extract("path", r"([a-z]+)_[^/]*$", 1)
    assert count_files(files).first().files == 3
    assert {(r.feed, r.files) for r in count_files(files, feed).collect()} == {("north", 2), ("south", 1)}
    assert count_files(files.limit(0)).first().files == 0


def relation(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().apply(0).relation().location()


def test_other_files_are_not_opened_and_the_directory_is_listed_once(spark, folder):
    opened = open_directory(spark, str(folder))
    found = read_files(opened, latest_files(listing(opened, NAMES)))
    # Neither is seen by what was opened before: one is listed and gone, the other there and not listed.
    (folder / "FILE_PREFIX_1.xlsx").unlink()
    put(folder, "FILE_PREFIX_7.xlsx", 1_900_000_000)
    assert names(found) == ["FILE_PREFIX_2.xlsx"] and bytes(found.first().content) == b"x"
    same = spark._jvm.java.lang.System.identityHashCode
    assert same(relation(found)) == same(relation(opened)) == same(relation(listing(opened)))
    scan = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "file_path" in scan.split("DataFilters: ")[1].split(", Format:")[0] and "FILE_PREFIX_1" not in scan
    opened = open_directory(spark, str(folder))
    (folder / "FILE_PREFIX_2.xlsx").unlink()
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
        read_files(opened, listing(opened, r"_2\.xlsx$")).collect()


def test_a_store_that_only_hadoop_knows(spark, tmp_path):
    """A mount table: no other library reads its scheme."""
    for n, name in enumerate(["north_1.xlsx", "north_2.xlsx", "per%20cent [1].xlsx"]):
        put(tmp_path, name, 1_700_000_000 + n, name.encode())
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    opened = open_directory(spark, "viewfs://store/in")
    feed = F.regexp_extract("path", r"([a-z]+)[^/]*$", 1)
    found = read_files(opened, latest_files(listing(opened), feed)).collect()
    assert {r.path: bytes(r.content) for r in found} == {
        f"viewfs://store/in/{n}": n.encode() for n in ["north_2.xlsx", "per%20cent [1].xlsx"]}
    assert bytes(read_file(spark, "viewfs://store/in/per%20cent [1].xlsx").first().content) == b"per%20cent [1].xlsx"


def test_many_chosen_files_are_read_by_several_scans(spark, tmp_path, monkeypatch):
    for n in range(23):
        put(tmp_path, f"f{n}.xlsx", 1_700_000_000, str(n).encode())
    monkeypatch.setattr(files, "PATHS_PER_SCAN", 5)
    opened = open_directory(spark, str(tmp_path))
    found = read_files(opened, listing(opened, r"^f1?\d\.xlsx$"))
    assert sorted(int(bytes(r.content)) for r in found.collect()) == list(range(20))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 4
