from __future__ import annotations

import json

import pytest

from conftest import values
from ticketloom import schemas
from ticketloom.operators import pages as ops
from ticketloom.plans import associations as plan
from ticketloom.plans.associations import MissingPages, load_associations, load_tickets
from ticketloom.sources import landed
from ticketloom.streaming import landing
from ticketloom.workload import pages as workload


def land(folder, name, *responses):
    (folder / name).write_text("\n".join(json.dumps(r) for r in responses))


def ticket(i, archived=False, **properties):
    return {"id": str(i), "properties": properties, "archived": archived}


def page(after, results, following=None):
    out = {"after": after, "results": results}
    if following is not None:
        out["paging"] = {"next": {"after": following}}
    return out


@pytest.fixture
def ticket_pages(tmp_path):
    land(tmp_path, "a.json", page(None, [ticket(1, subject="one"), ticket(2, True)], "p2"))
    land(tmp_path, "b.json", page("p2", [ticket(3, subject=None, hs_pipeline="0")], "p3"))
    land(tmp_path, "c.json", page("p3", []))
    return tmp_path


def test_load_tickets(spark, ticket_pages):
    out = load_tickets(spark, str(ticket_pages))
    assert out.columns == ["id", *schemas.TICKET_PROPERTIES]
    assert values(out, "id", "subject", "hs_pipeline") == [("1", "one", None), ("3", None, "0")]


def test_a_missing_page_fails_unless_allowed(spark, ticket_pages):
    land(ticket_pages, "d.json", page("p9", [ticket(9)], "p10"))
    with pytest.raises(MissingPages, match="p10"):
        load_tickets(spark, str(ticket_pages))
    assert load_tickets(spark, str(ticket_pages), allow_partial=True).count() == 3


def test_gaps(spark, ticket_pages):
    pages = landed.read_ticket_pages(spark, str(ticket_pages))
    assert values(ops.page_chain_gaps(pages)) == []
    without_p2 = pages.where("after is null or after <> 'p2'")
    assert values(ops.page_chain_gaps(without_p2)) == [("p2",)]


def test_empty_next_cursor_ends_the_chain(spark, tmp_path):
    land(tmp_path, "a.json", page(None, [ticket(1)], ""))
    pages = landed.read_ticket_pages(spark, str(tmp_path))
    assert values(ops.page_chain_gaps(pages)) == []


def test_malformed_response_fails_the_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"results": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        landed.read_ticket_pages(spark, str(tmp_path)).collect()


def test_whole_file_responses(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(page(None, [ticket(1)]), indent=2))
    pages = landed.read_ticket_pages(spark, str(tmp_path), whole_file=True)
    assert values(ops.flatten_ticket_pages(pages), "id") == [("1",)]


def item(i, kind="1"):
    return {"id": i, "associationTypeId": kind, "associationCategory": "C"}


def test_association_pages(spark, tmp_path):
    land(
        tmp_path,
        "a.json",
        {"ticket_id": "1", "status": "ok", "results": [item("x"), item("y"), {"id": None}]},
        {"ticket_id": "2", "status": "ok", "results": []},
        {"ticket_id": "3", "status": "ok"},
        {"ticket_id": "4", "status": "timeout", "results": [item("z")]},
        {"ticket_id": "5", "results": [item("w", "2")]},
    )
    loaded = load_associations(spark, str(tmp_path))
    assert values(loaded.edges, "ticket_id", "pos", "association_id", "association_type") == [
        ("1", 0, "x", "1"),
        ("1", 1, "y", "1"),
        ("1", 2, None, None),
        ("5", 0, "w", "2"),
    ]
    assert values(loaded.rejected) == [("4", "timeout")]
    responses = landed.read_association_pages(spark, str(tmp_path))
    assert values(ops.first_of_response(responses), "ticket_id", "association_id") == [
        ("1", "x"),
        ("5", "w"),
    ]


def test_batch_responses(spark, tmp_path):
    land(
        tmp_path,
        "a.json",
        {"results": [{"from": {"id": "1"}, "to": [item("x"), item("y")]}, {"from": {"id": "2"}, "to": []}]},
        {"results": []},
        {"status": "timeout"},
    )
    edges = ops.batch_edges(landed.read_batch_responses(spark, str(tmp_path)))
    assert values(edges, "ticket_id", "pos", "association_id") == [("1", 0, "x"), ("1", 1, "y")]


def test_emails_default_only_missing_properties(spark, tmp_path):
    land(
        tmp_path,
        "a.json",
        {"id": "e1", "properties": {"hs_email_subject": "S", "hs_email_text": None}},
        {"id": "e2", "properties": {}},
        {"id": "e3", "properties": {}, "archived": True},
    )
    emails = landed.read_emails(spark, str(tmp_path))
    assert values(emails, "id", "hs_email_subject", "hs_email_text") == [("e1", "S", None), ("e2", "", "")]


def test_stream_picks_up_new_pages_once(spark, tmp_path):
    source, table, progress = (tmp_path / n for n in ("pages", "tickets", "progress"))
    source.mkdir()

    def run():
        tickets = landing.stream_tickets(spark, str(source))
        landing.append_available(tickets, str(table), str(progress)).awaitTermination()
        return values(spark.read.parquet(str(table)), "id", "subject")

    land(source, "a.json", page(None, [ticket(1, subject="one"), ticket(2, True)], "p2"))
    assert run() == [("1", "one")]
    land(source, "b.json", page("p2", [ticket(3, subject="three")]))
    assert run() == [("1", "one"), ("3", "three")]
    assert run() == [("1", "one"), ("3", "three")]


def test_landed_edges_loses_no_response_of_a_large_order(spark, tmp_path):
    from pyspark.sql import functions as F

    from ticketloom.workload import pages as workload

    part = F.col("id").alias("l_partkey")
    lineitem = spark.range(5000).select(
        F.lit(1).cast("bigint").alias("l_orderkey"), part, F.lit(3).cast("bigint").alias("l_suppkey"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
    )
    lineitem.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert workload.landed_edges(spark, str(tmp_path)).count() == 5001


def test_different_responses_are_shuffled_once_as_short_columns(spark, tmp_path):
    from ticketloom.workload import pages as workload

    rows = [(1, 7, 3, "N", "O"), (1, 7, 3, "N", "O"), (1, 8, 3, "R", "O"), (1, 9, 3, "R", "F"), (2, 7, 3, None, "O")]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = workload._different_responses(spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 0
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    pages = sorted((r["ticket_id"], r["page"], len(r["results"] or [])) for r in found.collect())
    assert [(t, p) for t, p, _ in pages] == [("1", 0), ("1", 1), ("2", 0)] and sorted(n for *_, n in pages) == [0, 0, 2]
    assert values(workload.landed_edges(spark, str(tmp_path)), "ticket_id", "association_id") == [("1", "3"), ("1", "7")]


def test_batch_edges_in_turns_and_landed_text_is_compressed(spark, tmp_path, monkeypatch):
    result = {"from": {"id": "7"}, "to": [{"id": str(k % 5), "associationTypeId": "t"} for k in range(6)]}
    bodies = [(json.dumps({"status": "ok", "results": [result | {"from": {"id": str(k)}}]}),) for k in (7, 7, 8, 9)]
    monkeypatch.setattr(workload, "shared_path", lambda _, name: f"{tmp_path}/{name}")
    path = workload._landed(spark.createDataFrame(bodies, "body string"), "landed")
    files = list((tmp_path / "landed").glob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files)
    whole = load_associations(spark, batch_path=path).edges
    monkeypatch.setattr(plan, "EDGES_AT_ONCE", 5)
    found = load_associations(spark, batch_path=path).edges
    assert len(found.inputFiles()) >= len(whole.inputFiles()) and found.count() == 18
    assert values(found) == values(whole)
