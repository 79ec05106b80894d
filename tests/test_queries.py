"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entrypoint
from tools.check_queries import TABLES, TYPES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entrypoint.queries(), entrypoint.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    cursor = con.execute(SQL[name])
    names, kinds = [d[0] for d in cursor.description], {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(frame.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in frame.dtypes} == kinds
    assert rows_of(frame.collect(), frame.columns) == rows_of(cursor.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entrypoint.entry(spark).count() > 0


def test_the_other_queries_stay_without_the_optional_part(monkeypatch):
    def absent(name):
        raise ImportError(f"No module named 'xxhash', which {name} needs")

    monkeypatch.setattr(entrypoint, "import_module", absent)
    assert set(entrypoint.queries()) == {name for name in QUERIES if name in entrypoint.load_queries().QUERIES}
    assert set(entrypoint.oracle_sql()) <= set(entrypoint.queries())
