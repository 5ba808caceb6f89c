"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from markloom.workload import QUERIES
from markloom.workload.registry import table

from .conftest import SF_DIR

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got).equals(normal(want))


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 200


@pytest.mark.parametrize("name", ["documents", "pages", "part"])
def test_tables_that_texts_are_made_of_use_all_cores(spark, name):
    """One small file is one task, however long the texts made of its rows are."""
    assert table(spark, SF_DIR, name).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
