"""Landed responses: the tables' rows written as response bodies, then parsed and flattened.

A body is built from one row, so building it neither shuffles nor gathers a group, unless a
query groups or numbers pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions import nested
from ticketloom.operators import pages as ops
from ticketloom.operators.associations import first_association, merge_associations
from ticketloom.operators.joins import spread
from ticketloom.plans.associations import analyse_associations, known_tickets, load_associations, load_tickets
from ticketloom.sinks.csv_files import write_csv
from ticketloom.session import shared_path, staged
from ticketloom.sources.csv_files import read_csv
from ticketloom.workload.tables import table


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def page_envelope_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    bag = F.create_map(
        F.lit("hs_ticket_id"), _text("o_orderkey"),
        F.lit("subject"), F.col("o_orderstatus"),
        F.lit("hs_ticket_priority"), F.col("o_orderpriority"),
        F.lit("createdate"), F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    ticket = F.struct(
        _text("o_orderkey").alias("id"),
        bag.alias("properties"),
        (F.col("o_orderstatus") == "P").alias("archived"),
    )
    page = F.struct(_text("o_orderkey").alias("after"), F.array(ticket).alias("results"))
    bodies = table(spark, sf_dir, "orders").select(F.to_json(page).alias("body"))
    tickets = ops.flatten_ticket_pages(ops.decode_pages(bodies, "body"))
    return ops.project_properties(
        tickets, ["hs_ticket_id", "subject", "hs_ticket_priority", "createdate", "hs_pipeline"]
    )


def page_chain_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order that has line items, each pointing to the next order's page."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey")
    last = lineitem.agg(F.max("l_orderkey")).scalar()
    following = F.when(F.col("l_orderkey") < last, (F.col("l_orderkey") + 1).cast("string"))
    pages = lineitem.select(
        _text("l_orderkey").alias("after"),
        F.struct(F.struct(following.alias("after")).alias("next")).alias("paging"),
    )
    return ops.page_chain_gaps(pages)


def _items() -> Column:
    part = F.struct(
        _text("l_partkey").alias("id"),
        F.lit("part").alias("associationTypeId"),
        F.col("l_returnflag").alias("associationCategory"),
    )
    supplier = F.struct(
        _text("l_suppkey").alias("id"),
        F.lit("supplier").alias("associationTypeId"),
        F.col("l_linestatus").alias("associationCategory"),
    )
    return F.array(part, supplier)


def _association_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response per line item: its part, then its supplier. Returned ones list nothing."""
    body = F.struct(
        _text("l_orderkey").alias("ticket_id"),
        F.lit(ops.OK).alias("status"),
        F.when(F.col("l_returnflag") != "R", _items()).alias("results"),
    )
    bodies = table(spark, sf_dir, "lineitem").select(F.to_json(body).alias("body"))
    return ops.decode_pages(bodies, "body", schemas.ASSOCIATION_PAGE)


def association_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.association_edges(_association_pages(spark, sf_dir))


def first_of_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.first_of_response(_association_pages(spark, sf_dir))


def batch_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.struct(
        F.struct(_text("l_orderkey").alias("id")).alias("from"), _items().alias("to")
    )
    body = F.struct(F.lit(ops.OK).alias("status"), F.array(result).alias("results"))
    bodies = table(spark, sf_dir, "lineitem").select(F.to_json(body).alias("body"))
    return ops.batch_edges(ops.decode_pages(bodies, "body", schemas.BATCH_RESPONSE))


def property_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", schemas.PROPERTIES).alias("properties")
    )
    narrowed = objects.withColumn(
        "properties", nested.keep_properties(F.col("properties"), ["k", "note"])
    )
    return ops.project_properties(narrowed, ["k", "note"], default="", keep=["event_id"])


def rejected_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as responses: the failed ones, which must not count as 'no association'."""
    responses = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("response_id"),
        _text("user_id").alias("ticket_id"),
        F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit(ops.OK)).alias("status"),
    )
    return ops.rejected_responses(responses)


_WITHIN_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")


def _paged_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response per line item, numbered within its order. Those of flag 'A' landed twice, those
    of flag 'R' failed."""
    within = Window.partitionBy("l_orderkey").orderBy(*_WITHIN_ORDER)
    lineitem = table(spark, sf_dir, "lineitem")
    n_rows = lineitem.count()
    lineitem = spread(lineitem.select("l_orderkey", *_WITHIN_ORDER), n_rows, "l_orderkey")
    lineitem = lineitem.withColumn("page", F.row_number().over(within) - 1)
    twice = F.when(F.col("l_returnflag") == "A", 2).otherwise(1)
    status = F.when(F.col("l_returnflag") == "R", "timeout").otherwise(ops.OK)
    body = F.struct(
        _text("l_orderkey").alias("ticket_id"),
        F.col("page").cast("bigint").alias("page"),
        status.alias("status"),
        F.when(F.col("l_returnflag") != "R", _items()).alias("results"),
    )
    bodies = lineitem.select(F.explode(F.array_repeat(F.to_json(body), twice)).alias("body"))
    # At most two responses a line item.
    return ops.one_response_per_page(ops.decode_pages(bodies, "body", schemas.ASSOCIATION_PAGE), 2 * n_rows)


def paged_association_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.association_edges(_paged_responses(spark, sf_dir))


def paged_first_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_association(paged_association_edges(spark, sf_dir)).select("ticket_id", "association_id", "pos")


def _orders_as_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(_text("o_orderkey").alias("id"))


def known_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge that the job exports: without tickets of which a read failed."""
    responses = staged(_paged_responses(spark, sf_dir), "paged-responses")
    known = known_tickets(_orders_as_tickets(spark, sf_dir), ops.rejected_responses(responses))
    return merge_associations(known, ops.association_edges(responses)).select("id", "pos", "association_id")


def known_null_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = staged(_paged_responses(spark, sf_dir), "paged-responses")
    return analyse_associations(
        _orders_as_tickets(spark, sf_dir), ops.association_edges(responses), ops.rejected_responses(responses)
    ).nulls


def _landed(bodies: DataFrame, name: str) -> str:
    path = shared_path(bodies.sparkSession, name)
    bodies.select("body").write.option("compression", "gzip").text(path)
    return path


def landed_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 100 orders a page, written as JSON lines and loaded by the job's reader."""
    bag = F.create_map(F.lit("subject"), F.col("o_orderstatus"), F.lit("createdate"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    ticket = F.struct(_text("o_orderkey").alias("id"), bag.alias("properties"))
    number = F.floor(F.col("o_orderkey") / 100)
    pages = (
        table(spark, sf_dir, "orders")
        .groupBy(F.when(number > 0, number.cast("string")).alias("after"))
        .agg(F.collect_list(ticket).alias("results"))
    )
    path = _landed(pages.select(F.to_json(F.struct("after", "results")).alias("body")), "landed-tickets")
    return load_tickets(spark, path).select("id", "subject", "createdate")


def _different_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each different response of a ticket as a page, numbered so that no two share one.

    A response follows from a few short columns; these are dealt by ticket once, which serves
    to drop copies and to number the rest, and bodies are built last.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    n_rows = lineitem.count()
    listed = F.coalesce(F.col("l_returnflag") != "R", F.lit(False))
    named = ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    short = lineitem.select("l_orderkey", listed.alias("listed"), *[F.when(listed, F.col(c)).alias(c) for c in named])
    dealt = spread(short.repartition("l_orderkey"), n_rows, "l_orderkey").distinct()
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("listed", *named)) - 1
    return dealt.select(
        _text("l_orderkey").alias("ticket_id"),
        number.alias("page"),
        F.lit(ops.OK).alias("status"),
        F.when(F.col("listed"), _items()).alias("results"),
    )


def landed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = _different_responses(spark, sf_dir)
    path = _landed(responses.select(F.to_json(F.struct(*responses.columns)).alias("body")), "landed-responses")
    edges = load_associations(spark, path).edges
    return edges.select("ticket_id", "association_id", "association_type", "association_category").distinct()


def landed_batch_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch response per supplier and order: up to some dozens of results each."""
    result = F.struct(F.struct(_text("l_orderkey").alias("id")).alias("from"), _items().alias("to"))
    lineitem = table(spark, sf_dir, "lineitem")
    batches = (
        spread(lineitem, lineitem.count(), "l_orderkey", "l_suppkey")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(F.collect_list(result).alias("results"))
        .select(F.to_json(F.struct(F.lit(ops.OK).alias("status"), "results")).alias("body"))
    )
    edges = load_associations(spark, batch_path=_landed(batches, "landed-batches")).edges
    return edges.select("ticket_id", "association_id", "association_type", "association_category", "pos")


def csv_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of one column with NULL, empty, blank and multi-line values."""
    kind = F.pmod(F.col("conv_id"), F.lit(5))
    value = (
        F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("")).when(kind == 2, F.lit("  ")).otherwise(F.col("text"))
    )
    column = table(spark, sf_dir, "conversations").select(value.alias("value"))
    path = shared_path(spark, "csv_one_column")
    write_csv(column, path)
    return read_csv(spark, path, column.schema)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    path = shared_path(spark, "csv_roundtrip")
    write_csv(conversations, path)
    return read_csv(spark, path, conversations.schema)


_ASSOCIATION_ROWS = """
    SELECT CAST(l_orderkey AS VARCHAR) AS ticket_id, CAST(0 AS BIGINT) AS pos,
           CAST(l_partkey AS VARCHAR) AS association_id, 'part' AS association_type,
           l_returnflag AS association_category FROM lineitem
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR), CAST(1 AS BIGINT), CAST(l_suppkey AS VARCHAR), 'supplier',
           l_linestatus FROM lineitem
"""

_PAGED = f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS ticket_id, page * 4294967296 + place AS pos,
           CASE place WHEN 0 THEN CAST(l_partkey AS VARCHAR) ELSE CAST(l_suppkey AS VARCHAR) END AS association_id,
           CASE place WHEN 0 THEN 'part' ELSE 'supplier' END AS association_type,
           CASE place WHEN 0 THEN l_returnflag ELSE l_linestatus END AS association_category
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_WITHIN_ORDER)}) - 1 AS page FROM lineitem),
         (SELECT unnest([0, 1]) AS place)
    WHERE l_returnflag <> 'R'
"""
_KNOWN = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
"""

QUERIES = {
    "paged_association_edges": (paged_association_edges, _PAGED),
    "paged_first_association": (
        paged_first_association,
        f"""
        SELECT ticket_id, association_id, pos FROM ({_PAGED})
        QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY pos) = 1
        """,
    ),
    "known_merge": (
        known_merge,
        f"SELECT id, pos, association_id FROM ({_KNOWN}) LEFT JOIN ({_PAGED}) ON id = ticket_id",
    ),
    "known_null_share": (
        known_null_share,
        f"""
        SELECT null_rows, n_tickets, round(100.0::DOUBLE * null_rows / nullif(n_tickets, 0), 2) AS null_pct
        FROM (SELECT count(*) FILTER (association_id IS NULL) AS null_rows,
                     (SELECT count(*) FROM ({_KNOWN})) AS n_tickets
              FROM ({_KNOWN}) LEFT JOIN ({_PAGED}) ON id = ticket_id)
        """,
    ),
    "landed_tickets": (
        landed_tickets,
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS subject,
               strftime(o_orderdate, '%Y-%m-%d') AS createdate
        FROM orders
        """,
    ),
    "landed_edges": (
        landed_edges,
        f"""
        WITH listed AS (SELECT * FROM lineitem WHERE l_returnflag <> 'R')
        SELECT DISTINCT ticket_id, association_id, association_type, association_category
        FROM ({_ASSOCIATION_ROWS.replace("FROM lineitem", "FROM listed")})
        """,
    ),
    "landed_batch_edges": (
        landed_batch_edges,
        f"""
        SELECT DISTINCT ticket_id, association_id, association_type, association_category, pos
        FROM ({_ASSOCIATION_ROWS})
        """,
    ),
    "csv_one_column": (
        csv_one_column,
        """
        SELECT CASE conv_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE text END AS value
        FROM conversations
        """,
    ),
    "page_envelope_flatten": (
        page_envelope_flatten,
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS hs_ticket_id,
               o_orderstatus AS subject, o_orderpriority AS hs_ticket_priority,
               strftime(o_orderdate, '%Y-%m-%d') AS createdate, CAST(NULL AS VARCHAR) AS hs_pipeline
        FROM orders WHERE o_orderstatus <> 'P'
        """,
    ),
    "page_chain_gaps": (
        page_chain_gaps,
        """
        SELECT DISTINCT CAST(l_orderkey + 1 AS VARCHAR) AS missing_cursor FROM lineitem
        WHERE l_orderkey < (SELECT max(l_orderkey) FROM lineitem)
          AND l_orderkey + 1 NOT IN (SELECT l_orderkey FROM lineitem)
        """,
    ),
    "association_edges": (
        association_edges,
        f"""
        WITH listed AS (SELECT * FROM lineitem WHERE l_returnflag <> 'R')
        SELECT a.* FROM ({_ASSOCIATION_ROWS.replace("FROM lineitem", "FROM listed")}) a
        """,
    ),
    "first_of_response": (
        first_of_response,
        """
        SELECT CAST(l_orderkey AS VARCHAR) AS ticket_id, CAST(l_partkey AS VARCHAR) AS association_id,
               'part' AS association_type, l_returnflag AS association_category
        FROM lineitem WHERE l_returnflag <> 'R'
        """,
    ),
    "batch_edges": (batch_edges, _ASSOCIATION_ROWS),
    "property_project": (
        property_project,
        """
        SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
               coalesce(json_extract_string(props, '$.note'), '') AS note
        FROM events
        """,
    ),
    "rejected_responses": (
        rejected_responses,
        """
        SELECT event_id AS response_id, CAST(user_id AS VARCHAR) AS ticket_id, 'error' AS status
        FROM events WHERE event_type = 'error'
        """,
    ),
    "csv_roundtrip": (csv_roundtrip, "SELECT * FROM conversations"),
}
