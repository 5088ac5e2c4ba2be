"""Every query against its SQL, on whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quayside.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def sql(request):
    from conftest import SF_DIR

    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_agrees_with_sql(spark, sf_dir, sql, name):
    ours = entry.queries()[name](spark, sf_dir)
    columns = sorted(ours.columns)
    theirs = sql.sql(entry.oracle_sql()[name])
    assert sorted(theirs.columns) == columns
    ours = ours.select(*(f"`{c}`" for c in columns)).toArrow()
    theirs = theirs.project(", ".join(f'"{c}"' for c in columns)).to_arrow_table()
    assert [str(f.type) for f in ours.schema] == [str(f.type) for f in theirs.schema]
    assert sorted(map(str, ours.to_pylist())) == sorted(map(str, theirs.to_pylist()))


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1500
