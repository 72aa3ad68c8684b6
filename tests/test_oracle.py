"""Every query with SQL gives the same rows, values and kinds of value as DuckDB."""

import glob
import os

import duckdb
import pytest
from helpers import DATA

import __spark_entry__ as entry_file
from cdcflow.plans.all_queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(value):
    return (type(value).__name__, repr(value) if isinstance(value, float) else str(value))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_file.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(map(_plain, row)) for row in df.select(*columns).collect())
    sql = entry_file.oracle_sql().get(name)
    if sql is None:
        assert ours
        return
    result = duck.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = sorted(tuple(_plain(row[i]) for i in at) for row in result.fetchall())
    assert ours == theirs


def test_only_the_envelope_has_no_sql():
    assert set(QUERIES) - set(SQL) == {"emit_envelope"}


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
