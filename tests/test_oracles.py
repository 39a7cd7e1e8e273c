"""Every query of the library against its DuckDB twin over the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from flowtables.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())
