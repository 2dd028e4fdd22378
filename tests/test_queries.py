"""Every registered query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from pointmill.plans.oracles import oracles
from pointmill.plans.queries import QUERIES
from tests.helpers import canonical

TABLES = ["nation", "orders", "lineitem", "events"]
ORACLES = oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    answer = duck.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    assert canonical(result.columns, result.collect()) == canonical(names, answer.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4560
