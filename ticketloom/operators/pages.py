"""Landed API responses flattened into ticket, association and e-mail tables.

Each response is exploded where it lies: these operators add no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions import nested
from ticketloom.operators.joins import distinct_keys, spread, without_match

OK = "ok"
# A place in a response is below this; the place of an association is its page's times this, plus its own.
PAGE_PLACES = 1 << 32


def decode_pages(df: DataFrame, body: str, schema=schemas.TICKET_PAGE) -> DataFrame:
    """Response bodies held as JSON text, parsed into the envelope's columns.

    The one-element ``explode`` is where filters on the envelope stop: pushed below a
    plain projection they would have the text parsed again for each of them.
    """
    page = F.from_json(F.col(body), schema, {"mode": "FAILFAST"})
    return df.select(F.explode(F.array(page)).alias("page")).select("page.*")


def flatten_ticket_pages(pages: DataFrame) -> DataFrame:
    """All pages' tickets as one table (id, properties), archived ones left out."""
    return (
        pages.select(F.explode("results").alias("ticket"))
        .where(~F.coalesce(F.col("ticket.archived"), F.lit(False)))
        .select("ticket.id", "ticket.properties")
    )


def project_properties(
    objects: DataFrame,
    keys: Sequence[str],
    default: str | None = None,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """Named properties as columns; the bag itself is dropped."""
    bag = F.col("properties")
    return objects.select(
        *keep, *[nested.property_value(bag, key, default).alias(key) for key in keys]
    )


def page_chain_gaps(pages: DataFrame) -> DataFrame:
    """Cursors some page points to but no landed page was requested with.

    Both sides are reduced to distinct cursors first. An unbroken chain gives no rows.
    """
    return chain_gaps(pages, F.col("after"), nested.next_cursor(F.col("paging")))


def chain_gaps(pages: DataFrame, cursor: Column, following: Column) -> DataFrame:
    wanted = distinct_keys(pages.select(following.alias("c")), "c").toDF("missing_cursor")
    landed = pages.select(cursor.alias("landed_cursor"))
    return without_match(wanted, landed, "missing_cursor", "landed_cursor")


def _read_ok(status: Column) -> Column:
    return F.coalesce(status, F.lit(OK)) == OK


def association_edges(responses: DataFrame) -> DataFrame:
    """One row per association of each ticket's responses, ``pos`` = page, then response order.

    Responses that failed or list nothing contribute no rows. A response that was landed
    again counts again: see ``one_response_per_page``.
    """
    return (
        responses.where(_read_ok(F.col("status")))
        .select("ticket_id", _page(responses), F.posexplode("results").alias("pos", "item"))
        .select("ticket_id", *_edge_columns())
    )


def _page(responses: DataFrame) -> Column:
    page = F.col("page") if "page" in responses.columns else F.lit(None)
    return F.coalesce(page.cast("bigint"), F.lit(0)).alias("page")


def one_response_per_page(responses: DataFrame, n_rows: int = 0) -> DataFrame:
    """The landed responses without repeats: of each ticket and page one that was read, if there is one.

    Copies are combined map-side; of different answers the one with the greatest hash stays.
    Whole responses are sorted for this, so with ``n_rows`` told (about) many responses are
    dealt into more partitions first.
    """
    rest = [c for c in responses.columns if c not in ("ticket_id", "page")]
    rank = F.struct(_read_ok(F.col("status")), F.xxhash64(*rest))
    return (
        spread(responses.withColumn("page", _page(responses)), n_rows, "ticket_id", "page")
        .groupBy("ticket_id", "page")
        .agg(F.max_by(F.struct(*rest), rank).alias("kept"))
        .select(*[F.col(c) if c in ("ticket_id", "page") else F.col(f"kept.{c}") for c in responses.columns])
    )


def association_gaps(responses: DataFrame) -> DataFrame:
    """``(ticket_id, missing_cursor)``: pages of associations that a page points to but that never landed."""
    read = responses.where(_read_ok(F.col("status")))
    chain = read.select(
        "ticket_id",
        F.explode(
            F.array(
                F.struct(nested.next_cursor(F.col("paging")).alias("cursor"), F.lit(0).alias("landed")),
                F.struct(F.col("after").alias("cursor"), F.lit(1).alias("landed")),
            )
        ).alias("end"),
    )
    return (
        chain.where("end.cursor IS NOT NULL")
        .groupBy("ticket_id", F.col("end.cursor").alias("missing_cursor"))
        .agg(F.max("end.landed").alias("landed"))
        .where("landed = 0")
        .drop("landed")
    )


def batch_edges(responses: DataFrame) -> DataFrame:
    """The same from batch reads, where one response answers for several tickets."""
    return (
        responses.where(_read_ok(F.col("status")))
        .select(_page(responses), F.explode("results").alias("result"))
        .select(
            F.col("result.from.id").alias("ticket_id"),
            "page",
            F.posexplode("result.to").alias("pos", "item"),
        )
        .select("ticket_id", *_edge_columns())
    )


def _edge_columns() -> list[Column]:
    return [
        (F.col("page") * PAGE_PLACES + F.col("pos")).alias("pos"),
        F.col("item.id").alias("association_id"),
        F.col("item.associationTypeId").alias("association_type"),
        F.col("item.associationCategory").alias("association_category"),
    ]


def first_of_response(responses: DataFrame) -> DataFrame:
    """The first association straight from each ticket's first response; needs no grouping."""
    item = nested.first_item(F.col("results"))
    return responses.where(
        _read_ok(F.col("status")) & ~nested.has_no_items(F.col("results")) & (_page(responses) == 0)
    ).select(
        "ticket_id",
        item["id"].alias("association_id"),
        item["associationTypeId"].alias("association_type"),
        item["associationCategory"].alias("association_category"),
    )


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Responses whose read failed; their tickets must not pass for unassociated ones."""
    return responses.where(~_read_ok(F.col("status")))
