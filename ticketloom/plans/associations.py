"""Association job: landed pages to merged CSV, null analysis and e-mail expansion."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.operators import associations as assoc
from ticketloom.operators import pages
from ticketloom.operators.chains import ordered_tickets, page_order
from ticketloom.operators.joins import spread
from ticketloom.session import staged
from ticketloom.sinks.csv_files import write_csv, write_csv_run
from ticketloom.sources import landed


# So many edges of batch responses are shuffled at a time.
EDGES_AT_ONCE = 32_000_000


class MissingPages(RuntimeError):
    """A landed page points to a page that was never landed."""


def load_tickets(spark: SparkSession, path: str, allow_partial: bool = False) -> DataFrame:
    """All landed tickets; a broken page chain is an error unless partial data is allowed.

    The responses are parsed once, into a table that every later read uses.
    """
    landed_pages = staged(landed.read_ticket_pages(spark, path), "ticket-pages")
    if not allow_partial:
        missing = pages.page_chain_gaps(landed_pages).orderBy("missing_cursor").limit(5).collect()
        if missing:
            raise MissingPages(f"no page for cursors {[r.missing_cursor for r in missing]}")
    return pages.project_properties(
        pages.flatten_ticket_pages(landed_pages), schemas.TICKET_PROPERTIES
    )


class BrokenChains(RuntimeError):
    """The landed pages are not one unbroken, unambiguous chain per run."""


class OrderedTickets(NamedTuple):
    tickets: DataFrame
    faults: DataFrame


def load_ordered_tickets(
    spark: SparkSession, path: str, chain: Sequence[str] = (), allow_partial: bool = False
) -> OrderedTickets:
    """All landed tickets with their page and place, and what is wrong with the pages' chains.

    Any fault (see ``page_order``) is an error unless partial data is allowed; then tickets
    of detached pieces name the cursor their piece begins at, and those of pages on a
    ring have no page.
    """
    landed_pages = staged(landed.read_ticket_pages(spark, path), "ticket-pages")
    order = page_order(landed_pages, chain)
    if not allow_partial:
        found = order.faults.orderBy("kind", "cursor", "following").limit(5).collect()
        if found:
            raise BrokenChains(f"faults of the page chain: {[tuple(r) for r in found]}")
    tickets = ordered_tickets(landed_pages, order.places, chain)
    keep = [*chain, "piece", "page", "place", "id"]
    return OrderedTickets(
        pages.project_properties(tickets, schemas.TICKET_PROPERTIES, keep=keep), order.faults
    )


class Associations(NamedTuple):
    edges: DataFrame
    rejected: DataFrame


def load_associations(
    spark: SparkSession, path: str | None = None, batch_path: str | None = None, allow_partial: bool = False
) -> Associations:
    """Associations from per-ticket responses, batch responses or both, parsed once.

    Of a response that was landed again one counts; a missing page of a ticket's
    associations is an error unless partial data is allowed. Batch responses that
    failed name no ticket, so they are rejected with a NULL one.
    """
    found: list[Associations] = []
    if path is not None:
        responses = staged(
            # Lines are counted, not parsed.
            pages.one_response_per_page(landed.read_association_pages(spark, path), spark.read.text(path).count()),
            "association-pages",
        )
        if not allow_partial:
            missing = pages.association_gaps(responses).orderBy("ticket_id", "missing_cursor").limit(5).collect()
            if missing:
                raise MissingPages(f"no association pages for {[tuple(r) for r in missing]}")
        rejected = pages.rejected_responses(responses).select("ticket_id", "status")
        found.append(Associations(pages.association_edges(responses), rejected))
    if batch_path is not None:
        batches = staged(landed.read_batch_responses(spark, batch_path), "batch-responses")
        found_edges = pages.batch_edges(batches)
        n_edges = batches.select(F.sum(F.expr("aggregate(results, 0L, (n, r) -> n + coalesce(size(r.to), 0))"))).first()[0]
        edges = _distinct_in_turns(found_edges, n_edges or 0)
        rejected = pages.rejected_responses(batches).select(F.lit(None).cast("string").alias("ticket_id"), "status")
        found.append(Associations(edges, rejected))
    if not found:
        raise ValueError("a path of per-ticket or of batch responses is needed")
    return Associations(*[reduce(DataFrame.unionByName, parts) for parts in zip(*found, strict=True)])


def _distinct_in_turns(edges: DataFrame, n_edges: int) -> DataFrame:
    """The different rows of ``edges``, a written table, of ``EDGES_AT_ONCE`` edges at a time: what is
    shuffled for some of them is dropped before the next are."""
    turns = max(1, -(-n_edges // EDGES_AT_ONCE))
    turn = F.pmod(F.xxhash64(*edges.columns), F.lit(turns))
    parts = [edges.where(turn == k) if turns > 1 else edges for k in range(turns)]
    rows = -(-n_edges // turns)
    return reduce(DataFrame.unionAll, [staged(spread(p, rows, *p.columns).distinct(), "batch-edges") for p in parts])


class NullAnalysis(NamedTuple):
    nulls: DataFrame
    counts: DataFrame
    histogram: DataFrame


def analyse_associations(
    tickets: DataFrame, edges: DataFrame, rejected: DataFrame | None = None
) -> NullAnalysis:
    """Null associations, counts per ticket and their distribution.

    Tickets whose read was rejected are left out: nothing is known about them.
    """
    tickets = known_tickets(tickets, rejected)
    counts = assoc.association_counts(tickets, edges)
    return NullAnalysis(
        assoc.null_associations(tickets, edges), counts, assoc.association_histogram(counts)
    )


def known_tickets(tickets: DataFrame, rejected: DataFrame | None) -> DataFrame:
    """The tickets whose associations were read: nothing is known about the others'."""
    if rejected is None:
        return tickets
    return assoc.tickets_without_association(tickets, rejected.select("ticket_id"))


def export_merged(
    tickets: DataFrame,
    edges: DataFrame,
    output_base: str,
    moment: dt.datetime | None = None,
    rejected: DataFrame | None = None,
) -> str:
    """The left merge of tickets and associations as one CSV directory per run.

    Tickets whose read was rejected are not in it, as they are not in the analysis.
    """
    merged = assoc.merge_associations(known_tickets(tickets, rejected), edges)
    return write_csv_run(merged, f"{output_base.rstrip('/')}/merged_data", moment)


def export_tables(
    tables: dict[str, DataFrame], output_base: str, moment: dt.datetime | None = None
) -> dict[str, str]:
    """Each table as one CSV directory of this run; gives their paths."""
    moment = moment or dt.datetime.now()
    return {
        name: write_csv_run(table, f"{output_base.rstrip('/')}/{name}", moment) for name, table in tables.items()
    }


class ExpandedEmails(NamedTuple):
    emails: DataFrame
    unresolved: DataFrame
    per_ticket: DataFrame


def expand_emails(tickets: DataFrame, edges: DataFrame, emails: DataFrame) -> ExpandedEmails:
    """All e-mails of the tickets, the associations that led nowhere, and e-mails per ticket."""
    edges = assoc.edges_of_tickets(tickets, edges)
    expanded = assoc.ticket_emails(edges, emails)
    return ExpandedEmails(
        expanded,
        assoc.unresolved_emails(edges, emails),
        assoc.emails_per_ticket(tickets.select("id"), expanded),
    )


def export_ticket_emails(
    tickets: DataFrame, edges: DataFrame, emails: DataFrame, output_path: str
) -> str:
    """The tickets' e-mails as CSV, the input of the e-mail content job."""
    write_csv(expand_emails(tickets, edges, emails).emails, output_path, mode="overwrite")
    return output_path
