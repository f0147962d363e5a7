"""Ticket extracts from the warehouse tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions import dates, text

# Hexadecimal digits of the hash that a sample's reach is counted by.
SAMPLE_DIGITS = 3

Day = dt.date | str | Column | None

# The key columns of the raw ticket table.
RAW_PREVIEW_COLUMNS = (
    "id",
    "property_subject",
    "property_content",
    "property_createdate",
    "property_hs_lastmodifieddate",
    "property_hubspot_owner_id",
    "property_hs_pipeline",
    "property_hs_pipeline_stage",
)


def support_tickets(
    mart: DataFrame,
    raw: DataFrame,
    as_of: Day = None,
    days: int = 30,
    pipeline: str = "Support",
    source: str = "EMAIL",
    mart_key: str = "ticket_id",
    raw_key: str = "id",
) -> DataFrame:
    """Recent tickets of one pipeline and source, with their raw content if there is any.

    The three predicates are on ``mart`` alone and are evaluated in its scan, so only the
    window's tickets reach the join. ``mart`` is the preserved side, which adaptive
    execution may split if one of its keys is hot; ``raw`` has one row per id.
    """
    recent = mart.where(
        dates.in_last_days(F.col("create_date"), days, as_of)
        & (F.col("pipeline_name") == pipeline)
        & (F.col("source_type") == source)
    ).select(
        F.col("ticket_id").cast("string").alias("ticket_id"),
        F.col("create_date").alias("creation_date"),
        F.col("subject").alias("ticket_subject"),
        F.col(mart_key).alias("__mart_key"),
    )
    content = raw.select(
        F.col(raw_key).alias("__raw_key"), F.col("property_content").alias("ticket_content")
    )
    return recent.join(content, F.col("__mart_key") == F.col("__raw_key"), "left").select(
        "ticket_id", "creation_date", "ticket_subject", "ticket_content"
    )


def recent_tickets(
    raw: DataFrame,
    as_of: Day = None,
    days: int = 30,
    moment: str = "property_createdate",
    tie_break: str = "id",
    cutoff: str | None = None,
) -> DataFrame:
    """All columns of the tickets of the last ``days`` days, newest first.

    ``cutoff`` (``YYYY-MM-DD``) replaces the rolling window by a fixed first day.
    """
    kept = (
        dates.on_or_after(F.col(moment), cutoff)
        if cutoff is not None
        else dates.in_last_days(F.col(moment), days, as_of)
    )
    return raw.where(kept).orderBy(F.col(moment).desc(), F.col(tie_break))


def preview(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    n: int = 5,
    width: int = 50,
) -> DataFrame:
    """The first ``n`` rows of some columns, text cut to ``width`` for display."""
    kinds = dict(df.dtypes)
    shown = [
        text.display_text(F.col(c), width).alias(c) if kinds[c] == "string" else F.col(c)
        for c in columns
    ]
    return df.orderBy(*order_by).limit(n).select(*shown)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's column and row counts."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return (
        df.agg(F.count("*").alias("n_rows"))
        .select("n_rows", F.inline(columns))
        .select(
            "position",
            "column_name",
            "column_type",
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            "n_rows",
        )
    )


def table_size(df: DataFrame) -> DataFrame:
    """One row: how many rows and columns a table has."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def sample_tickets(tickets: DataFrame, n: int = 100, seed: str = "0", key: str = "id") -> DataFrame:
    """``n`` tickets drawn uniformly without replacement; the same ones on every run.

    They are the first in the order of a seeded hash. Counting its first digits tells how
    far the first ``n`` reach, so little more than them is sorted, however many tasks read.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")).cast("binary"))
    digits = F.coalesce(F.substring(draw, 1, SAMPLE_DIGITS), F.lit(""))
    counts = tickets.groupBy(digits.alias("digits")).agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("digits"))  # at most 16 ** SAMPLE_DIGITS rows
    reach = (
        counts.select("digits", so_far.alias("so_far"))
        .where(F.col("so_far") >= n)
        .select(F.min("digits"))
        .scalar()
    )
    return tickets.where(F.coalesce(digits <= reach, F.lit(True))).orderBy(draw, key).limit(n)
