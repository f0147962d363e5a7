"""The registered queries of the subpackage, with their SQL where there is some."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from oracle import duck, duck_rows, spark_rows
from ticketloom.llm.queries import QUERIES

NATIVE = ["op1_line_dedup", "op3_decontaminate_simhash", "op5_chat_windows", "op9_url_filter"]


def test_all_are_registered():
    registered = entry_points.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(n) for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(registered)
    assert "pipeline" not in entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_matches_sql(name, spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    query, sql = QUERIES[name]
    columns, rows = spark_rows(query(spark, small))
    assert (columns, rows) == duck_rows(duck(small), sql)


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(name, spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    plan = QUERIES[name][0](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
