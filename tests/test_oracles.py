"""Every registered query with a SQL counterpart gives the same rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    yield con
    con.close()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_matches_sql(spark, duck, sf, name):
    df = entry_points.queries()[name](spark, sf)
    ours = _rows(df.columns, df.collect())
    rel = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert ours == _rows(rel.columns, rel.fetchall())


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "label" in df.columns
