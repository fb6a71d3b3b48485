"""Every query against its DuckDB counterpart on the smallest test tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from testkit.oracles import oracle_sql
from testkit.queries import queries

DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    return con


def test_every_query_has_a_counterpart():
    assert set(SQL) == set(queries())


@pytest.mark.parametrize("name", list(SQL))
def test_matches(spark, duck, name):
    df = queries()[name](spark, DIR)
    columns = sorted(df.columns)
    found = sorted(tuple(map(repr, row)) for row in df.select(*columns).collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted(tuple(repr(row[i]) for i in order) for row in result.fetchall())
    assert found == wanted


def test_entry(spark):
    assert entry(spark).columns[0] == "run_id"
