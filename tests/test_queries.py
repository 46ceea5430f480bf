"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.workbook.oracles import oracle_sql
from starloom.workbook.queries import QUERIES

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert table(df.columns, rows) == table(want.columns, want.fetchall())


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0
