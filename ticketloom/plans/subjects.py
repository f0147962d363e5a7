"""Subject comparison of a sample of tickets with their first e-mails."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from ticketloom.operators import compare
from ticketloom.operators.tickets import sample_tickets


# Up to this many sampled tickets are broadcast.
FEW_TICKETS = 10_000


class SubjectReport(NamedTuple):
    comparison: DataFrame
    match_rate: DataFrame
    matches: DataFrame
    mismatches: DataFrame


def compare_subjects(
    tickets: DataFrame,
    edges: DataFrame,
    emails: DataFrame,
    sample: int | None = 100,
    seed: str = "0",
    order_by: Sequence[str] = ("pos",),
    ties: Sequence[str] = ("association_id",),
    unique_emails: bool = False,
) -> SubjectReport:
    """Compare ``sample`` tickets (``None``: all of them) with their first e-mails.

    A small sample is broadcast: edges and e-mails are filtered by it where they lie.
    """
    if sample is not None:
        tickets = sample_tickets(tickets.select("id", "subject"), sample, seed)
    comparison = compare.first_email_compare(
        tickets,
        edges,
        emails,
        order_by,
        ties,
        few_tickets=sample is not None and sample <= FEW_TICKETS,
        unique_emails=unique_emails,
    )
    return SubjectReport(
        comparison,
        compare.subject_match_rate(comparison),
        compare.subject_matches(comparison),
        compare.subject_mismatches(comparison),
    )
