"""Warehouse jobs: the support-ticket extract and the dump of recent raw tickets."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ticketloom.operators import tickets as ops
from ticketloom.sinks.csv_files import write_csv_run
from ticketloom.sources.tables import read_table


def extract_support_tickets(
    spark: SparkSession, mart: str, raw: str, fmt: str = "parquet", **options
) -> DataFrame:
    """Recent tickets of a pipeline and source; options as in ``support_tickets``."""
    return ops.support_tickets(
        read_table(spark, mart, fmt), read_table(spark, raw, fmt), **options
    )


class TicketDump(NamedTuple):
    path: str
    profile: DataFrame
    preview: DataFrame
    written: DataFrame


def dump_recent_tickets(
    spark: SparkSession,
    raw: str,
    output_base: str,
    as_of: dt.date | str | None = None,
    days: int = 30,
    fmt: str = "parquet",
    moment: dt.datetime | None = None,
) -> TicketDump:
    """Write the recent tickets, newest first, as CSV; give the path, the raw table's profile,
    a preview, and how many rows and columns were written."""
    table = read_table(spark, raw, fmt)
    recent = ops.recent_tickets(table, as_of, days)
    path = write_csv_run(recent, f"{output_base.rstrip('/')}/tickets_last_month", moment)
    shown = [c for c in ops.RAW_PREVIEW_COLUMNS if c in table.columns]
    first = ops.recent_tickets(table, as_of, days).limit(5).select(*shown)
    return TicketDump(path, ops.table_profile(table), first, ops.table_size(recent))
