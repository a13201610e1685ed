"""Every registered query against its SQL, values and column names included."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from eventpulse.plans.catalog import QUERIES
from eventpulse.plans.oracles import ORACLES


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir_module):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir_module}/events.parquet')")
    return con


@pytest.fixture(scope="module")
def sf_dir_module():
    from tests.conftest import SF_DIR

    return SF_DIR


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck, sf_dir_module):
    result = queries()[name](spark, sf_dir_module)
    expected = duck.execute(oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    assert canonical(result.collect(), result.columns) == canonical(expected.fetchall(), names)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10
    assert rows == sorted(rows, key=lambda r: (-r.event_count, r.repo_name))
