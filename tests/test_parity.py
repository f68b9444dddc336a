"""Every registered query with a SQL twin, compared as whole results on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from ebbtide import registry
from parity import TABLES, compare

from .conftest import SF

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    text, _, good = compare(spark, con, name, entry.queries()[name], SQL[name], SF)
    assert good, text


def test_every_query_is_registered_once():
    assert set(SQL) <= set(entry.queries())
    assert len(registry.QUERIES) - len(registry.ORACLES) < 20


def test_flagship(spark):
    assert entry.entry(spark).count() == 4
