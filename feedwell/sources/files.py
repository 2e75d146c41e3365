"""Files in a directory, the newest per feed, and their bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwell.functions.paths import basename
from feedwell.operators.history import latest_per

#: Paths that one scan is pruned to; more chosen files are read by several scans.
PATHS_PER_SCAN = 5_000
_LISTED = ("path", "modificationTime", "length")


def open_directory(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """The files directly in ``directory`` with their bytes: (path, modificationTime, length, content).

    The directory is listed here, once, through Spark's own file systems, so any store that Spark is
    set up for will do. Bytes are read where ``content`` is asked for. ``glob`` narrows the listing.
    An empty directory gives no rows, a missing one raises.
    """
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", False)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory)


def list_files(
    spark: SparkSession, directory: str, name_regex: str | None = None, glob: str | None = None,
) -> DataFrame:
    """(path, modificationTime, length) of the files directly in ``directory``; no file is opened.

    ``name_regex`` is matched against the file name; ``glob`` narrows the listing itself.
    """
    return listing(open_directory(spark, directory, glob), name_regex)


def listing(directory: DataFrame, name_regex: str | None = None) -> DataFrame:
    """The listing of an open directory, of the names that match."""
    files = directory.select(*_LISTED)
    return files if name_regex is None else match_names(files, name_regex)


def match_names(files: DataFrame, name_regex: str, path: str = "path") -> DataFrame:
    """Files whose name (what follows the last slash) matches, case-sensitively."""
    return files.filter(F.regexp_like(basename(path), F.lit(name_regex)))


def newest_first(files: DataFrame) -> DataFrame:
    """The listing in the order newest first; of equal times the greater path first."""
    return files.orderBy(F.desc("modificationTime"), F.desc("path"))


def count_files(files: DataFrame, feed: Column | None = None) -> DataFrame:
    """How many files there are (``files``), or with ``feed`` how many of each feed."""
    grouped = files.groupBy() if feed is None else files.groupBy(feed.alias("feed"))
    return grouped.agg(F.count(F.lit(1)).alias("files"))


def latest_files(files: DataFrame, feed: Column | None = None) -> DataFrame:
    """The newest file of all, or with ``feed`` the newest of each feed (adds ``feed``)."""
    listed = files.select("path", "modificationTime", "length")
    if feed is None:
        return newest_first(listed).limit(1)
    named = listed.withColumn("feed", feed)
    return latest_per(named, ["feed"], ["modificationTime", "path"]).select("feed", *listed.columns)


def read_files(directory: DataFrame, chosen: DataFrame, path: str = "path") -> DataFrame:
    """The files of an open directory whose paths are chosen, with their bytes, and of no others.

    A scan takes a bounded list of paths, which prunes its files before any is opened; the listing is
    the one that the directory was opened with. The paths, part of that listing, pass through the
    driver; bytes do not. A file that is gone by now fails the task.
    """
    # The scan knows its files by their encoded paths.
    named = directory.select("path", F.col("_metadata.file_path").alias("__at"))
    wanted = chosen.select(F.col(path).alias("path")).distinct()
    scans = [
        directory.filter(F.col("_metadata.file_path").isin(paths))
        for paths in _batches(r[0] for r in named.join(wanted, "path").select("__at").toLocalIterator())
    ]
    return reduce(lambda a, b: a.unionAll(b), scans) if scans else directory.limit(0)


def _batches(paths: Iterator[str]) -> Iterator[list[str]]:
    held = []
    for path in paths:
        held.append(path)
        if len(held) == PATHS_PER_SCAN:
            yield held
            held = []
    if held:
        yield held


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """One file by its exact path; raises ``FileNotFoundError`` when there is no such file or it is empty."""
    loaded = spark.read.option("ignoreMissingFiles", False).format("binaryFile")
    try:
        file = loaded.load(_escaped(path))
        found = file.select("path", "length").limit(2).collect()
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise FileNotFoundError(path) from problem
        raise
    if len(found) != 1 or found[0].path.rpartition("/")[2] != path.rstrip("/").rpartition("/")[2]:
        raise FileNotFoundError(f"{path} is not one file")
    if not found[0].length:
        raise FileNotFoundError(f"{path} is empty")
    return file


def _escaped(path: str) -> str:
    """The path with glob characters taken literally."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
