"""The registered queries: every operator over whole stand-in tables, with its SQL twin.

Orders play the tickets, line items their associations, suppliers the e-mails,
conversations a ticket's thread, documents and pages the e-mail bodies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, tuple[Query, str | None]]:
    from ticketloom.workload import answers, associations, chains, detector, language, pages, phrases, tickets

    merged: dict[str, tuple[Query, str | None]] = {}
    for module in (tickets, associations, pages, chains, language, detector, phrases, answers):
        merged.update(module.QUERIES)
    return merged
