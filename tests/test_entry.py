"""Every query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    found = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = database.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in expected.fetchall()]
    got = [tuple(row[c] for c in columns) for row in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize(
    "name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql()))
)
def test_query_without_sql_gives_rows(spark, name):
    assert entry_point.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() == 281
