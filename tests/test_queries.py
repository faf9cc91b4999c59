"""Every registered query against its SQL twin on the smallest test tables."""

import datetime as dt
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from muster import session
from muster.queries.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def in_order(found):
    return sorted((tuple(plain(v) for v in row) for row in found), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = contract.queries()[name](spark, FOLDER)
    names = sorted(df.columns)
    found = in_order(df.select(*[f"`{c}`" for c in names]).collect())
    answer = database.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == names
    places = [columns.index(c) for c in names]
    assert found == in_order([tuple(row[i] for i in places) for row in answer.fetchall()])


@pytest.mark.parametrize("name,keys", [("run_histogram", ["generic", "slice"]), ("backtest_monthly", ["generic"])])
def test_tasks_grow_with_rows(spark, monkeypatch, name, keys):
    """The sorts by unit are dealt to as many tasks as the rows call for, whatever the settings."""
    few = len(QUERIES[name](spark, FOLDER).collect())
    monkeypatch.setattr(session, "TASK_ROWS", 150, raising=False)
    df = QUERIES[name](spark, FOLDER)
    assert len(df.collect()) == few
    columns = "".join(rf"{key}#\d+, " for key in keys)
    found = re.findall(rf"hashpartitioning\({columns}(\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().toString())
    assert found and int(found[0]) > 4


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "generic"
