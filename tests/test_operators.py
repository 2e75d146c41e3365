"""Headers, rows, counts and history against direct loops and small fixtures."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedwell.functions import key_of, marker_of
from feedwell.operators import (
    canonical_rows, change_gate, drop_blank_keys, history_record, keep_changes, latest_per, latest_record,
    load_stats, missing_columns, resolve_flag, resolve_headers, resolve_headers_all,
)

WORDS = ["Cold", "cöld ", "FLAG", "fläg marker1", "Flag\tMARKER2", "blue", "", "co", "ﬂag marker 1", None, "x"]


@pytest.fixture(scope="module")
def header_rows():
    draw = random.Random(5)
    return [(f, o, draw.choice(WORDS) if draw.random() < 0.7 else draw.choice(WORDS) or "" + str(o))
            for f in "abcdef" for o in range(draw.randrange(1, 12))]


@pytest.fixture(scope="module")
def headers(spark, header_rows):
    return spark.createDataFrame(header_rows, "file string, ordinal int, header string")


def lists(header_rows):
    files = {}
    for file, _, header in header_rows:
        files.setdefault(file, []).append(header)
    return files


def test_headers_equal_a_direct_loop(headers, header_rows):
    prefixes = ["cóld", "FLAG", "co", "nothing"]
    every, first, missing = set(), set(), set()
    for file, names in lists(header_rows).items():
        seen = set()
        for t, prefix in enumerate(prefixes):
            hits = [(o, n) for o, n in enumerate(names) if key_of(n).startswith(key_of(prefix))]
            first |= {(file, prefix, *hit) for hit in hits[:1]}
            missing |= {(file, prefix)} if not hits else set()
            for o, n in hits:
                if n not in seen:
                    seen.add(n)
                    every.add((file, n, t, o))
    targets = {p: p for p in prefixes}
    assert {tuple(r) for r in resolve_headers_all(headers, prefixes, ["file"]).collect()} == every
    assert {tuple(r) for r in resolve_headers(headers, targets, ["file"]).collect()} == first
    assert {tuple(r) for r in missing_columns(headers, targets, ["file"]).collect()} == missing


def test_flag_header_equals_a_direct_loop(headers, header_rows):
    expected = set()
    for file, names in lists(header_rows).items():
        hits = [
            (o, n) for o, n in enumerate(names)
            if key_of(n).startswith("flag") and any(marker_of(m) in marker_of(n) for m in ("marker1", "Marker 2"))
        ]
        expected |= {(file, *hit) for hit in hits[:1]}
    found = resolve_flag(headers, "flag", ["marker1", "Marker 2"], ["file"])
    assert {tuple(r) for r in found.collect()} == expected and expected


def test_header_tables_use_hash_aggregates(headers):
    for df in [resolve_headers(headers, {"a": "co", "b": "fl"}, ["file"]), resolve_flag(headers, "flag", ["m"], ["file"])]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "SinglePartition" not in plan and "NestedLoop" not in plan
    for df in [missing_columns(headers, {"a": "co"}, ["file"]), resolve_headers_all(headers, ["co"], ["file"])]:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan and "SinglePartition" not in plan


def test_rows_and_counts(spark):
    df = spark.createDataFrame(
        [("a", "y"), (" ", "y"), (None, "y"), ("\t", None), ("b", ""), ("c", "0")], "k string, f string"
    )
    assert [r.k for r in drop_blank_keys(df, "k").collect()] == ["a", "\t", "b", "c"]
    assert load_stats(df, "k", "f").first() == (6, 4, 3)
    assert load_stats(df, "k").first() == (6, 4, 0)
    assert load_stats(df.filter("k = 'none'"), "k", "f").first() == (0, 0, 0)
    rows = canonical_rows(df, {"column_a": "k"})
    assert rows.columns == ["column_a", "flag", "has_flag"] and rows.filter("has_flag or flag is not null").isEmpty()


T0 = datetime(2024, 1, 1)


def record(feed, name, minute, count):
    return (feed, f"/in/{name}.xlsx", T0 + timedelta(minutes=minute), count)


def records(spark, *rows):
    df = spark.createDataFrame(rows, "feed string, path string, at timestamp, n int")
    return history_record(df, "path", F.col("at"), "n", keep=["feed"])


def gate(new, history):
    passed = change_gate(new, history, ["feed"], ["processing_timestamp", "recorded_at"])
    return sorted((r.feed, r.filename, r.flagged_line_count) for r in passed.collect())


def test_history_record(spark):
    df = records(spark, record("f", "A", 61, 3))
    assert df.schema.simpleString() == (
        "struct<feed:string,filename:string,processing_timestamp:string,flagged_line_count:bigint,recorded_at:timestamp>"
    )
    assert df.first()[:4] == ("f", "A.xlsx", "2024-01-01 01:01", 3)


def test_gate_compares_with_the_latest_record_only(spark):
    runs = [("A", 3), ("A", 3), ("A", 4), ("B", 4), ("A", 4)]
    history, appended = records(spark, record("f", "A", 0, 3)).limit(0), []
    for i, (name, count) in enumerate(runs, 1):
        new = records(spark, record("f", name, i, count))
        if gate(new, history):
            appended.append(i)
            history = history.union(new)
    assert appended == [1, 3, 4, 5]
    every = records(spark, *[record("f", name, i, count) for i, (name, count) in enumerate(runs, 1)])
    replayed = keep_changes(every, ["feed"], ["recorded_at"], ["filename", "flagged_line_count"])
    assert sorted(r.recorded_at.minute for r in replayed.collect()) == [1, 3, 4, 5]


def test_gate_by_feed_and_within_one_minute(spark):
    old = records(spark, record("f", "A", 1, 1), record("g", "B", 1, 1), record("g", "B", 0, 9))
    later = old.filter("feed = 'f'").withColumns({
        "recorded_at": F.expr("recorded_at + interval 5 seconds"), "flagged_line_count": F.lit(2).cast("long"),
    })
    new = records(spark, record("f", "A", 2, 2), record("g", "B", 2, 9), record("h", "C", 2, 0))
    assert gate(new, old.union(later)) == [("g", "B.xlsx", 9), ("h", "C.xlsx", 0)]


def test_gate_treats_null_counts_as_equal(spark):
    null = records(spark, record("f", "A", 1, None))
    assert gate(null, null) == [] and gate(records(spark, record("f", "A", 2, 0)), null) == [("f", "A.xlsx", 0)]


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_changes_equal_a_direct_loop_with_a_hot_feed(spark, hot, partitions):
    draw = random.Random(f"{hot}{partitions}")
    data = [
        (
            "hot" if draw.random() < hot else draw.choice([None, *"abcdefg"]), draw.choice([None, *range(50)]), i,
            draw.choice([None, 1, 1, 1, 2]),
        )
        for i in range(3_000)
    ]
    expected, last = set(), {}
    for feed, at, i, n in sorted(data, key=lambda r: (r[0] or "", -1 if r[1] is None else r[1], r[2])):
        if feed not in last or last[feed] != n:
            expected.add(i)
        last[feed] = n
    df = spark.createDataFrame(data, "feed string, at int, id long, n int").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = keep_changes(df, ["feed"], ["at", "id"], ["n"])
        assert found.columns == df.columns
        assert sorted(r.id for r in found.collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_copies_are_split_and_count_once(spark, partitions):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        line = spark.range(2_000).select(F.lit("f").alias("feed"), "id", ((F.col("id") / 3).cast("int") % 2).alias("n"))
        copies = spark.range(4_000).select(F.lit("f").alias("feed"), F.lit(1_000).cast("long").alias("id"), F.lit(7).alias("n"))
        df = line.filter("id <> 1000").union(copies).union(copies).repartition(16)
        found = [tuple(r) for r in keep_changes(df, ["feed"], ["id"], ["n"]).orderBy("id").collect()]
        states = [7 if i == 1_000 else (i // 3) % 2 for i in range(2_000)]
        assert found == [("f", i, s) for i, s in enumerate(states) if i == 0 or states[i - 1] != s]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_feed_is_split(spark):
    """The rows of one feed are spread over tasks, in order."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(80_000).select(F.lit("hot").alias("feed"), "id", (F.col("id") % 3).alias("n"))
        plan = keep_changes(df, ["feed"], ["id"], ["n"])
        assert plan.count() == 80_000
        wide = df.repartitionByRange("feed", "id").groupBy(F.spark_partition_id()).count()
        assert wide.agg(F.max("count")).first()[0] < 80_000 / 4
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning(" in text and "SinglePartition" not in text
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 0, 9)], "g string, at int, id int")
    assert sorted(tuple(r) for r in latest_per(df, ["g"], ["at", "id"]).collect()) == [("a", 2, 3), ("b", 0, 9)]
    newest = latest_record(df, ["at", "id"])
    assert newest.first() == ("a", 2, 3)
    assert "TakeOrderedAndProject" in newest._jdf.queryExecution().executedPlan().toString()


RUNS = st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 2)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(RUNS)
def test_the_gate_run_by_run_and_the_replay_agree(spark, runs):
    """Feeds include NULL; three equal runs of one leave one record."""
    schema = "feed string, at int, flagged_line_count long, filename string"
    rows = [(feed, at, count, "f") for at, (feed, count) in enumerate(runs)]
    kept, held = [], {}
    for row in rows:
        if held.get(row[0]) != row[2]:
            kept.append(row)
        held[row[0]] = row[2]
    replayed = keep_changes(spark.createDataFrame(rows, schema), ["feed"], ["at"], ["filename", "flagged_line_count"])
    assert sorted(map(tuple, replayed.collect()), key=repr) == sorted(kept, key=repr)
    last = spark.createDataFrame(rows[-1:], schema)
    passed = change_gate(last, spark.createDataFrame(rows[:-1], schema), ["feed"], ["at"]).count()
    assert passed == (rows[-1] in kept)
