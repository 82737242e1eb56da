"""Every registered query with SQL against DuckDB on the smallest tables: same columns, same rows."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, 0 if v is None else v) for v in row])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = ordered([tuple(plain(row[c]) for c in cols) for row in df.collect()])
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = ordered([tuple(plain(row[i]) for i in at) for row in cursor.fetchall()])
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert [pytest.approx(v, abs=2e-6) if isinstance(v, float) else v for v in w] == list(g)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.columns
    assert df.limit(1).count() == 1


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
