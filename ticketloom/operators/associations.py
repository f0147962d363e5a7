"""Tickets and their associated e-mails: merge, counts, first association, expansion.

``tickets`` has a key column ``id``; ``edges`` has ``ticket_id``, ``association_id`` and
payload columns. Every count is aggregated per ticket before it meets another table, so
a ticket with very many associations is one row by the time it is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.ratios import percent
from ticketloom.operators.joins import (
    ROWS_PER_SHARE,
    dealt,
    distinct_keys,
    join_many_to_one,
    left_join_to_many,
    without_match,
)


def merge_associations(
    tickets: DataFrame, edges: DataFrame, rows_per_share: int = ROWS_PER_SHARE
) -> DataFrame:
    """Tickets left-merged with their associations, both key columns kept."""
    return left_join_to_many(tickets, edges, "id", "ticket_id", rows_per_share)


def tickets_without_association(tickets: DataFrame, edges: DataFrame) -> DataFrame:
    return without_match(tickets, edges, "id", "ticket_id")


def _edge_totals(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("ticket_id").isNotNull())
        .groupBy("ticket_id")
        .agg(F.count("*").alias("n_edges"), F.count("association_id").alias("n_ids"))
    )


def _ticket_totals(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("id").agg(F.count("*").alias("n_copies"))


def association_counts(tickets: DataFrame, edges: DataFrame) -> DataFrame:
    """Non-null associations per ticket of the merge, grouped by the edge side's key.

    Tickets without edges have a null key there and are therefore not counted.
    """
    return (
        _ticket_totals(tickets)
        .join(_edge_totals(edges), F.col("id") == F.col("ticket_id"), "inner")
        .select("ticket_id", (F.col("n_copies") * F.col("n_ids")).alias("n_associations"))
    )


def association_histogram(counts: DataFrame) -> DataFrame:
    """How many tickets have how many associations, by number of associations."""
    return (
        counts.groupBy("n_associations").agg(F.count("*").alias("n_tickets")).orderBy("n_associations")
    )


def null_associations(tickets: DataFrame, edges: DataFrame) -> DataFrame:
    """Merged rows with a null association id, and their share of the ticket count.

    Counted are tickets without edges and edges without an id, over tickets: several
    null edges of one ticket push the share above that of tickets without association.
    """
    nulls = F.when(F.col("n_edges").isNull(), 1).otherwise(F.col("n_edges") - F.col("n_ids"))
    return (
        _ticket_totals(tickets)
        .join(_edge_totals(edges), F.col("id") == F.col("ticket_id"), "left")
        .agg(
            F.coalesce(F.sum(F.col("n_copies") * nulls), F.lit(0)).alias("null_rows"),
            F.coalesce(F.sum("n_copies"), F.lit(0)).alias("n_tickets"),
        )
        .withColumn("null_pct", percent(F.col("null_rows"), F.col("n_tickets")))
    )


def _total_order(edges: DataFrame, order_by: Sequence[str], ties: Sequence[str]) -> list[str]:
    """``order_by``, then ``ties``, then every other column, so that no choice is left open."""
    return list(dict.fromkeys((*order_by, *ties, *[c for c in edges.columns if c != "ticket_id"])))


def first_association(
    edges: DataFrame, order_by: Sequence[str] = ("pos",), ties: Sequence[str] = ("association_id",)
) -> DataFrame:
    """Each ticket's first association in response order, ties broken by ``ties``.

    The minimum of a struct that leads with the order columns: an aggregate, not a
    ranking, so each map task sends one row per ticket however many it holds.
    """
    return (
        edges.groupBy("ticket_id")
        .agg(F.min(F.struct(*_total_order(edges, order_by, ties))).alias("first"))
        .select(*[F.col(c) if c == "ticket_id" else F.col(f"first.{c}") for c in edges.columns])
    )


def associations_topk(
    edges: DataFrame,
    k: int,
    order_by: Sequence[str] = ("pos",),
    ties: Sequence[str] = ("association_id",),
    rows_per_share: int = ROWS_PER_SHARE,
) -> DataFrame:
    """At most ``k`` associations per ticket, as a single capped API read would return.

    A hot ticket is dealt into shares, each of which keeps its first ``k`` in a task of
    its own, before the shares' firsts are ranked together. Spark applies a limit of up
    to 1,000 in each map task already.
    """
    order = _total_order(edges, order_by, ties)
    shares, share = dealt(edges, "ticket_id", rows_per_share)
    in_share = Window.partitionBy("ticket_id", share).orderBy(*order)
    firsts = shares.withColumn("__rank", F.row_number().over(in_share)).where(F.col("__rank") <= k)
    w = Window.partitionBy("ticket_id").orderBy(*order)
    return (
        firsts.drop("__rank", share)
        .withColumn("rank", F.row_number().over(w).cast("bigint"))
        .where(F.col("rank") <= k)
    )


def edges_of_tickets(
    tickets: DataFrame, edges: DataFrame, rows_per_share: int = ROWS_PER_SHARE
) -> DataFrame:
    """The associations of the given tickets only."""
    keys = distinct_keys(tickets, "id").toDF("__ticket")
    return join_many_to_one(edges, keys, "ticket_id", "__ticket", "left_semi", rows_per_share)


def one_per_id(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per id: of several, the least in the order of the remaining columns.

    Copies are combined map-side, and a later join on the id reuses the partitioning.
    """
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("__row"))
        .select(*[F.col(c) if c == key else F.col(f"__row.{c}") for c in df.columns])
    )


def ticket_emails(
    edges: DataFrame,
    emails: DataFrame,
    unique_emails: bool = False,
    rows_per_share: int = ROWS_PER_SHARE,
) -> DataFrame:
    """Every association expanded with its e-mail; unresolvable ones are dropped.

    An e-mail that several tickets share is read, and so landed, once for each of them;
    its copies count once here, or they would pair up with all its associations.
    ``unique_emails`` says that ids do not repeat and saves that step.
    """
    details = emails.select(
        F.col("id").alias("__email_id"),
        F.col("hs_email_subject").alias("subject"),
        F.col("hs_email_text").alias("content"),
        F.col("hs_timestamp").alias("timestamp"),
    )
    if not unique_emails:
        details = one_per_id(details, "__email_id")
    return join_many_to_one(
        edges.select("ticket_id", "association_id"),
        details,
        "association_id",
        "__email_id",
        rows_per_share=rows_per_share,
    ).drop("__email_id")


def unresolved_emails(
    edges: DataFrame, emails: DataFrame, rows_per_share: int = ROWS_PER_SHARE
) -> DataFrame:
    """Associations whose e-mail is missing: what ``ticket_emails`` leaves out."""
    return join_many_to_one(
        edges.select("ticket_id", "association_id"),
        distinct_keys(emails, "id").toDF("__email_id"),
        "association_id",
        "__email_id",
        "left_anti",
        rows_per_share,
    )


def emails_per_ticket(tickets: DataFrame, expanded: DataFrame) -> DataFrame:
    """E-mails found per ticket, zero included."""
    found = expanded.groupBy("ticket_id").agg(F.count("*").alias("n_found"))
    return tickets.join(found, F.col("id") == F.col("ticket_id"), "left").select(
        F.col("id").alias("ticket_id"), F.coalesce("n_found", F.lit(0)).alias("n_emails")
    )
