"""Every registered query against its SQL on DuckDB, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from oracle import duck, duck_rows, spark_rows
from ticketloom.workload import registry

QUERIES = {name: query for name, (query, _) in registry().items()}
SQL = {name: sql for name, (_, sql) in registry().items() if sql is not None}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, sf_dir, con):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected_rows = duck_rows(con, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected_rows)
    assert rows == expected_rows


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["n_associations", "n_tickets"]
    assert df.count() > 0
