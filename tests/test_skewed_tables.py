"""The registered queries over tables in which one key or one copied row holds a third of all rows."""

from __future__ import annotations

import duckdb
import pytest

from conftest import TESTDATA
from oracle import TABLES, duck, duck_rows, spark_rows
from ticketloom.operators import joins
from ticketloom.workload import registry

SOURCE = TESTDATA / "sf0.001"
QUERIES = {name: query for name, (query, _) in registry().items()}
SQL = {name: sql for name, (_, sql) in registry().items()}

# Which row of a table is copied until the copies make up a third of it.
COPIED = {
    "orders": "o_orderkey = 42",
    "customer": "true",
    "supplier": "true",
    "conversations": "role = 'assistant'",
    "documents": "lang = 'de'",
    "pages": "true",
    "events": "event_type = 'error'",
}


def added(name: str) -> str | None:
    half = f"(SELECT count(*) // 2 FROM {name})"
    if name == "lineitem":
        return f"SELECT * REPLACE (77 AS l_orderkey) FROM lineitem ORDER BY ALL LIMIT {half}"
    if name in COPIED:
        one = f"SELECT * FROM {name} WHERE {COPIED[name]} ORDER BY ALL LIMIT 1"
        return f"SELECT one.* FROM ({one}) one, range({half})"
    return None


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SOURCE}/{name}.parquet')")
    for name in TABLES:
        extra = f" UNION ALL ({added(name)})" if added(name) else ""
        con.execute(f"COPY (SELECT * FROM {name}{extra}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def con(skewed):
    return duck(skewed)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql_on_skewed_tables(name, spark, skewed, con):
    columns, rows = spark_rows(QUERIES[name](spark, skewed))
    expected_columns, expected_rows = duck_rows(con, SQL[name])
    assert columns == expected_columns
    assert rows == expected_rows


@pytest.mark.parametrize("name", ["paged_association_edges", "known_null_share", "landed_batch_edges"])
def test_large_tables_in_more_partitions(name, spark, monkeypatch):
    small = str(TESTDATA / "sf0.001")
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 300)
    with_parts = []
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "repartition", lambda df, n, *keys, of=frame.repartition: with_parts.append(n) or of(df, n, *keys))
    query, sql = registry()[name]
    assert spark_rows(query(spark, small)) == duck_rows(duck(small), sql)
    assert with_parts and min(with_parts) >= 20
