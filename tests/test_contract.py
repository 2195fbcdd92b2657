"""Every registered query against its DuckDB text on the smallest tables."""

from collections import Counter
import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["year_published", "month_published", "month_date"]
    assert df.count() == 83


def test_checks_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect())
    assert got
    text = contract.oracle_sql().get(name)
    if text is None:
        return
    cur = db.execute(text)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cur.description} == dict(df.dtypes)
    at = [names.index(c) for c in cols]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
