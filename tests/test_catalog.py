"""Every named query against its SQL, over whole tables at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import SAME_TYPE, rows_of
from tillwarden.catalog.registry import ENTRIES


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_equals_sql(spark, sf_dir, sql, name):
    df = entry.queries()[name](spark, sf_dir)
    theirs = sql.execute(entry.oracle_sql()[name]).df()
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in sql.description}
    mine = df.toPandas()
    assert len(mine) > 0 and rows_of(mine) == rows_of(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
