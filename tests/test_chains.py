"""Places of pages and faults of their chains, against a plain walk."""

from __future__ import annotations

import json
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from ticketloom.operators.chains import ordered_tickets, page_order
from ticketloom import session
from ticketloom.operators import chains
from ticketloom.plans.associations import BrokenChains, load_ordered_tickets

PAGES = "run string, after string, following string"


def plain_order(rows):
    """Per chain: every cursor's (piece, place), and the faults."""
    places, faults = {}, set()
    for run in {r for r, _, _ in rows}:
        followers: dict = {}
        for r, after, following in rows:
            if r == run:
                followers.setdefault(after or "", set()).update({following} - {None, ""})
        chosen = {c: min(f) if f else None for c, f in followers.items()}
        led_to = {f for f in chosen.values() if f in chosen}
        for c, every in followers.items():
            faults |= {(run, "gap", c or None, f) for f in every if f not in chosen}
            faults |= {(run, "fork", c or None, f) for f in every if f != chosen[c]}
        at: dict = {}
        for head in sorted(c for c in chosen if c == "" or c not in led_to):
            if head:
                faults.add((run, "detached", head, None))
            c, k = head, 0
            while c in chosen and c not in at:
                at[c] = (head, k)
                c, k = chosen[c], k + 1
        for c, f in chosen.items():
            head, place = at.get(c, (None, None))
            places[run, c or None] = (head or None, place)
            if f in chosen:
                if head is None or (at[f][0] == head and at[f][1] <= place):
                    faults.add((run, "loop", c or None, f))
                elif at[f][0] != head:
                    faults.add((run, "merge", c or None, f))
    return places, faults


def check(spark, rows):
    frame = spark.createDataFrame(rows, PAGES)
    order = page_order(frame, ["run"], F.col("after"), F.col("following"))
    places, faults = plain_order(rows)
    found = order.places.collect()
    assert len(found) == len(places)
    assert {(r["run"], r["cursor"]): (r["piece"], r["place"]) for r in found} == places
    rows = [tuple(r) for r in order.faults.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == faults


@pytest.mark.parametrize("seed", range(3))
def test_random_chains(spark, seed):
    rng = random.Random(seed)
    rows = []
    for run in ("a", "b", None):
        names = [f"{run}{k:03d}" for k in rng.sample(range(1000), 60)]
        cursors = [None, *names]
        for k, cursor in enumerate(cursors):
            following = cursors[k + 1] if k + 1 < len(cursors) else None
            if rng.random() < 0.08:
                following = rng.choice([None, "", "nowhere", rng.choice(names), cursor])
            rows.append((run, cursor, following))
            if rng.random() < 0.05:
                rows.append((run, cursor, rng.choice([following, rng.choice(names)])))
            if rng.random() < 0.05:
                rows.append((run, f"ring{k}", f"ring{k}"))
    check(spark, rows)


def test_a_long_chain_and_rings(spark):
    rows = [("r", str(k) if k else "", str(k + 1)) for k in range(700)]
    rows += [("s", f"c{k}", f"c{(k + 1) % 5}") for k in range(5)] + [("t", "in", "c0"), ("t", "c0", "c1"), ("t", "c1", "c0")]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [("r", None, None)], [("r", "", "")], [("r", "x", None)], [("r", "x", "x")]])
def test_smallest_chains(spark, rows):
    check(spark, rows)


def test_tickets_keep_the_order_of_their_pages(spark):
    ticket = "struct<id:string,properties:map<string,string>,archived:boolean>"
    schema = f"after string, results array<{ticket}>, paging struct<next:struct<after:string>>"

    def page(after, following, *ids):
        return (after, [(i, {"p": i}, i == "gone") for i in ids], ((following,),) if following else None)

    pages = [page("z", "b", "3", "gone", "1"), page(None, "z", "9", "8"), page("b", None, "2"), page("b", None, "2"), page("q", None)]
    frame = spark.createDataFrame(pages, schema)
    order = page_order(frame)
    found = ordered_tickets(frame, order.places).orderBy("piece", "page", "place").collect()
    assert [r["id"] for r in found] == ["9", "8", "3", "1", "2"]
    assert [(r["page"], r["place"]) for r in found] == [(0, 0), (0, 1), (1, 0), (1, 2), (2, 0)]
    assert values(order.faults, "kind", "cursor") == [("detached", "q")]


def test_the_job_reads_pages_in_order_or_fails(spark, tmp_path):
    def line(after, following, *ids):
        results = [{"id": i, "properties": {"subject": f"s{i}"}} for i in ids]
        return json.dumps({"after": after, "results": results, "paging": {"next": {"after": following}} if following else None})

    whole = [line("b", "a", "3"), line(None, "b", "1", "2"), line("a", None, "4")]
    (tmp_path / "whole.json").write_text("\n".join(whole))
    (tmp_path / "broken.json").write_text("\n".join(whole[:2] + [line("lost", None, "9")]))
    found = load_ordered_tickets(spark, str(tmp_path / "whole.json"))
    rows = found.tickets.orderBy("page", "place").select("id", "subject").collect()
    assert [tuple(r) for r in rows] == [(i, f"s{i}") for i in "1234"] and found.faults.isEmpty()
    with pytest.raises(BrokenChains, match="lost"):
        load_ordered_tickets(spark, str(tmp_path / "broken.json"))
    partial = load_ordered_tickets(spark, str(tmp_path / "broken.json"), allow_partial=True)
    assert values(partial.tickets, "id", "piece", "page") == [("1", None, 0), ("2", None, 0), ("3", None, 1), ("9", "lost", 0)]
    assert values(partial.faults, "kind", "cursor", "following") == [("detached", "lost", None), ("gap", "b", "a")]


def test_rounds_pass_nothing_through_the_driver(spark, monkeypatch):
    plans = []

    def staged(df, name):
        if name == "page-ranks":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.staged(df, name)

    monkeypatch.setattr(chains, "staged", staged)
    pages = spark.range(40).select(
        F.when(F.col("id") > 0, F.col("id").cast("string")).alias("after"), (F.col("id") + 1).cast("string").alias("following")
    )
    places = chains.page_order(pages, cursor=F.col("after"), following=F.col("following")).places
    assert [r["place"] for r in places.orderBy("place").collect()] == list(range(40))
    assert len(plans) > 5 and not any("Broadcast" in plan for plan in plans[1:])
