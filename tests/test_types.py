"""Inferred types, and targets that are a table."""

import pytest
from pyspark.sql import functions as F

from feedwell.operators import infer_types, merge_flags, resolve_headers, resolve_targets, type_flags, type_name, typed, with_inferred_types

COLUMNS = {
    "bigint": ["0", "-7", "9223372036854775807", None], "double": ["1", "2.5", "1e-05", "-0.5"], "boolean": ["True", None, "False"],
    "date": ["2024-02-29", "2024-01-31 00:00:00"], "timestamp_ntz": ["2024-02-29", "2024-01-31 10:00:00.5"], "string": ["1", "x"],
}
TEXTS = [["007"], ["9223372036854775808", "x"], ["2024-02-30"], ["True", "1"], ["true"], ["nan"], ["1 "], ["+1"], [" "], [""], ["2024-1-1"], [None], []]


def one(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return infer_types(df, ["v"]).first().type


@pytest.mark.parametrize("kind", COLUMNS)
def test_types(spark, kind):
    assert one(spark, COLUMNS[kind]) == kind


def test_what_would_not_come_back_is_text(spark):
    assert [one(spark, values) for values in TEXTS] == ["string"] * len(TEXTS)
    assert one(spark, ["9223372036854775808"]) == "double"


def test_flags_of_parts_merge_into_those_of_the_whole(spark):
    values = [(str(n), v) for n, v in enumerate([*COLUMNS["bigint"], "2.5", *COLUMNS["date"], None])]
    df = spark.createDataFrame(values, "k string, v string")
    parts = type_flags(df, ["v"], ["k"])
    for subset in (["0", "1", "3"], ["0", "4"], ["5", "6"], ["3"], ["0", "5"]):
        own = df.filter(F.col("k").isin(subset))
        merged = merge_flags(parts.filter(F.col("k").isin(subset)), ["v"]).select(type_name(F.col("v")))
        assert merged.first()[0] == infer_types(own, ["v"]).first().type


def test_typed_rows(spark):
    rows = [("1", "2024-01-31 00:00:00", "True", "a"), (None, "2024-02-01", None, None)]
    df = spark.createDataFrame(rows, "n string, day string, flag string, other string")
    found = with_inferred_types(df, df.columns)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "date", "boolean", "string"]
    assert [str(r.day) for r in found.orderBy(F.desc("n")).collect()] == ["2024-01-31", "2024-02-01"]
    assert typed(df, {"other": "bigint"}).first().other is None
    with pytest.raises(ValueError, match="unknown types"):
        typed(df, {"n": "int"})


def test_one_aggregate(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    plan = infer_types(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


HEADERS = [("f1", 0, "Cölumn A"), ("f1", 1, "column b"), ("f1", 2, "COLUMN A (old)"), ("f2", 0, "Other"), ("f2", 1, "col"), (None, 0, "column")]


def test_a_table_of_targets_equals_literals(spark):
    headers = spark.createDataFrame(HEADERS, "feed string, ordinal int, header string")
    wanted = {"a": "COLUMN a", "any": "Col", "long": "column a (old) and more", "none": "zzz"}
    feeds = ["f1", "f2", None]
    targets = spark.createDataFrame([(f, t, p) for f in feeds for t, p in wanted.items()], "feed string, target string, prefix string")
    found = resolve_targets(headers, targets, ["feed"])
    expected = resolve_headers(headers, wanted, ["feed"])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    one = targets.filter("feed = 'f2'").union(targets.filter("feed = 'f2'"))
    assert [tuple(r) for r in resolve_targets(headers, one, ["feed"]).collect()] == [("f2", "any", 1, "col")]


def test_an_empty_prefix_fails(spark):
    headers = spark.createDataFrame(HEADERS, "feed string, ordinal int, header string")
    targets = spark.createDataFrame([("f1", "a", " ß ")], "feed string, target string, prefix string")
    with pytest.raises(Exception, match="would match every name"):
        resolve_targets(headers, targets, ["feed"]).collect()


def test_ten_thousand_targets_are_an_equal_join(spark):
    headers = spark.range(30_000).select(
        (F.col("id") % 3).cast("string").alias("feed"), F.col("id").alias("ordinal"), F.concat(F.lit("name "), F.col("id").cast("string")).alias("header"))
    targets = spark.range(10_000).select(
        (F.col("id") % 3).cast("string").alias("feed"), F.col("id").cast("string").alias("target"),
        F.concat(F.lit("Näme"), F.col("id").cast("string")).alias("prefix"))
    found = resolve_targets(headers, targets, ["feed"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    rows = {r.target: r.ordinal for r in found.collect()}
    assert len(rows) == 10_000 and all(rows[str(n)] == n for n in range(0, 10_000, 37))
