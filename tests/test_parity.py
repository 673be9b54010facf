"""Every query that has SQL gives the SQL's rows; every other one runs."""

from collections import Counter
from glob import glob
from os.path import basename

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")


def plain(value):
    return round(value, 6) if isinstance(value, float) else tuple(map(plain, value)) if isinstance(value, list | tuple) else value


@pytest.fixture(scope="module")
def connection(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf_dir, connection, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name in (sql := entry.oracle_sql()):
        result = connection.execute(sql[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        want = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
        assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
