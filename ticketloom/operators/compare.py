"""Ticket subject against the subject of the first associated e-mail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.ratios import percent
from ticketloom.functions.text import same_text
from ticketloom.operators.associations import first_association, one_per_id
from ticketloom.operators.joins import join_many_to_one


def first_email_compare(
    tickets: DataFrame,
    edges: DataFrame,
    emails: DataFrame,
    order_by: Sequence[str] = ("pos",),
    ties: Sequence[str] = ("association_id",),
    few_tickets: bool = False,
    unique_emails: bool = False,
) -> DataFrame:
    """Ticket -> first association -> e-mail; tickets lacking either give no row.

    Ids are looked up: a ticket or e-mail id that occurs more than once counts once, with
    the least of its values (``unique_emails`` says that e-mail ids do not repeat). The
    edges shrink to one row per ticket before they meet anything else.

    ``few_tickets`` promises tickets that fit into a broadcast: then edges and e-mails are
    filtered by them where they lie instead of being shuffled.
    """
    rank = list(dict.fromkeys((*order_by, *ties, "association_id")))
    lookups = edges.select("ticket_id", *rank)
    subject = F.min("subject").alias("ticket_subject")
    details = emails.select(
        F.col("id").alias("__email_id"),
        F.col("hs_email_subject").alias("email_subject"),
        F.col("hs_email_text").alias("email_text"),
        F.col("hs_email_html").alias("email_html"),
    )
    columns = ["ticket_id", "ticket_subject", "email_subject", "email_text", "email_html"]
    if not few_tickets:
        if not unique_emails:
            details = one_per_id(details, "__email_id")
        # Without the filter here the join's own one would make its input differ from the counted one.
        keyed = lookups.where(F.col("ticket_id").isNotNull())
        first = first_association(keyed, order_by, ties).select("ticket_id", "association_id")
        subjects = tickets.groupBy("id").agg(subject)
        titled = first.join(subjects, F.col("ticket_id") == F.col("id"), "inner").drop("id")
        found = join_many_to_one(titled, details, "association_id", "__email_id", counted=first)
        return found.select(*columns)

    wanted = F.broadcast(tickets.select("id", "subject"))
    first = (
        lookups.join(wanted, F.col("ticket_id") == F.col("id"), "inner")
        .groupBy("ticket_id")
        .agg(F.min(F.struct(*rank)).alias("first"), subject)
        .select("ticket_id", "ticket_subject", "first.association_id")
    )
    same_email = F.col("association_id") == F.col("__email_id")
    found = details.join(F.broadcast(first), same_email, "inner")
    if not unique_emails:
        found = one_per_id(found.select(*columns), "ticket_id")
    return found.select(*columns)


def _matches():
    return same_text(F.col("ticket_subject"), F.col("email_subject"))


def subject_matches(comparison: DataFrame) -> DataFrame:
    return comparison.where(_matches())


def subject_mismatches(comparison: DataFrame) -> DataFrame:
    """The complement of ``subject_matches``: a missing subject counts as a mismatch."""
    return comparison.where(~_matches())


def subject_match_rate(comparison: DataFrame) -> DataFrame:
    return comparison.agg(
        F.count("*").alias("n_compared"), F.count_if(_matches()).alias("n_matches")
    ).withColumn("match_pct", percent(F.col("n_matches"), F.col("n_compared")))
