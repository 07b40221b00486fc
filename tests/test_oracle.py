"""Every query against its SQL, run by DuckDB on the same tables."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return v.isoformat() if isinstance(v, dt.date) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    assert got, "no rows"
    if name not in SQL:
        return
    rel = duck.sql(SQL[name])
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: TYPES[df.schema[c].dataType.simpleString()] for c in cols} == types
    at = [rel.columns.index(c) for c in cols]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert len(df.columns) > 80 and len(set(df.columns)) == len(df.columns)


def test_sorted_is_in_order(spark):
    got = [tuple(r) for r in QUERIES["q_sorted"](spark, SMALL).collect()]
    assert got == sorted(got)
