"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

from ticketloom.workload import registry

QUERIES = {name: query for name, (query, _) in registry().items()}
PYTHON = {"provider_translate", "provider_failures", "trained_language", "trained_language_confusion", "phrase_substitution"}
# The tickets of one page, the phrases within one text.
SMALL_LISTS = {"tickets_in_order", "phrase_substitution"}


def plan(spark, sf_dir, name) -> str:
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product_and_python_only_for_providers(name, spark, sf_dir):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert ("Python" in text) == (name in PYTHON)
    assert "collect_list" not in text or name in SMALL_LISTS


@pytest.mark.parametrize(
    "name",
    [
        "page_envelope_flatten",
        "association_edges",
        "batch_edges",
        "first_of_response",
        "rejected_responses",
        "property_project",
        "clean_content",
        "truncate_content",
        "detect_language",
        "language_route",
        "glossary_translate",
        "translate_content",
        "provider_translate",
        "csv_roundtrip",
    ],
)
def test_row_wise_work_does_not_shuffle(name, spark, sf_dir):
    assert "Exchange" not in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name", ["support_ticket_extract", "recent_tickets", "tickets_since_cutoff"])
def test_date_window_reaches_the_scan(name, spark, sf_dir):
    assert "GreaterThanOrEqual(o_orderdate" in plan(spark, sf_dir, name)


def test_counts_read_only_the_key_columns(spark, sf_dir):
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan(spark, sf_dir, "association_histogram"))
    assert sorted(schemas) == ["struct<l_orderkey:bigint,l_suppkey:bigint>", "struct<o_orderkey:bigint>"]


@pytest.mark.parametrize("name", ["sample_tickets", "preview"])
def test_limits_are_top_n(name, spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, name)


def test_window_thins_out_the_raw_table_before_its_shuffle(spark, sf_dir, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
    )
    assert "might_contain" in plan(spark, sf_dir, "support_ticket_extract")
