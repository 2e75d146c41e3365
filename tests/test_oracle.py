"""Every registered query against its SQL on the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
OPTIONAL = set(entry_points._optional("QUERIES"))  # tested on their own; not all have SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) - OPTIONAL == set(SQL) - OPTIONAL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(expected) and found
    assert rows(df.columns, found) == rows(columns, expected)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
