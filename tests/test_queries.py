"""Every query against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check_queries import compare
from rollout_quality.queries.oracle import oracles
from rollout_quality.queries.spark import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracles())
    assert set(QUERIES) <= set(entry_points.queries()) and set(oracles()) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, sf_dir)
    assert ok, note


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
