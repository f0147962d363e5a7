"""Ticket extracts, profile, preview and sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions import dates
from ticketloom.operators import tickets as ops
from ticketloom.workload.tables import AS_OF, table, tickets


def support_ticket_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderdate").alias("create_date"),
        F.col("o_orderpriority").alias("subject"),
        F.col("o_orderstatus").alias("pipeline_name"),
        F.col("o_orderpriority").alias("source_type"),
        "o_custkey",
    )
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("property_content")
    )
    return ops.support_tickets(
        mart, raw, AS_OF, pipeline="O", source="1-URGENT", mart_key="o_custkey"
    )


def recent_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.recent_tickets(
        table(spark, sf_dir, "orders"), AS_OF, moment="o_orderdate", tie_break="o_orderkey"
    )


def tickets_since_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window given as a formatted day, with the day and stamp of each ticket as text."""
    recent = ops.recent_tickets(
        table(spark, sf_dir, "orders"),
        moment="o_orderdate",
        tie_break="o_orderkey",
        cutoff="2001-07-02",
    )
    return recent.select(
        "o_orderkey",
        dates.date_text(F.col("o_orderdate")).alias("created_day"),
        dates.stamp_text(F.col("o_orderdate")).alias("created_stamp"),
    )


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.table_profile(table(spark, sf_dir, "orders"))


def dump_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows and columns the dump of the recent orders has."""
    return ops.table_size(recent_tickets(spark, sf_dir))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.preview(table(spark, sf_dir, "documents"), ["doc_id", "lang", "text"], ["doc_id"])


def sample_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sample_tickets(tickets(spark, sf_dir).select("id"))


_ORDER_COLUMNS = (
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
)
_PROFILE_ROWS = ", ".join(
    f"(CAST({i} AS BIGINT), '{name}', '{kind}')" for i, (name, kind) in enumerate(_ORDER_COLUMNS)
)

QUERIES = {
    "dump_profile": (
        dump_profile,
        f"""
        SELECT count(*) AS n_rows, CAST({len(_ORDER_COLUMNS)} AS BIGINT) AS n_columns FROM orders
        WHERE CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' - INTERVAL 30 DAY
        """,
    ),
    "support_ticket_extract": (
        support_ticket_extract,
        f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, o_orderdate AS creation_date,
               o_orderpriority AS ticket_subject, c_name AS ticket_content
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey
        WHERE CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' - INTERVAL 30 DAY
          AND o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
        """,
    ),
    "recent_tickets": (
        recent_tickets,
        f"""
        SELECT * FROM orders
        WHERE CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' - INTERVAL 30 DAY
        ORDER BY o_orderdate DESC, o_orderkey
        """,
    ),
    "tickets_since_cutoff": (
        tickets_since_cutoff,
        """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS created_day,
               strftime(o_orderdate, '%Y%m%d_%H%M%S') AS created_stamp
        FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-02'
        """,
    ),
    "table_profile": (
        table_profile,
        f"""
        SELECT position, column_name, column_type, CAST({len(_ORDER_COLUMNS)} AS BIGINT) AS n_columns,
               (SELECT count(*) FROM orders) AS n_rows
        FROM (VALUES {_PROFILE_ROWS}) AS c(position, column_name, column_type)
        """,
    ),
    "preview": (
        preview,
        """
        SELECT doc_id, lang,
               CASE WHEN length(text) > 50 THEN left(text, 47) || '...' ELSE text END AS text
        FROM documents ORDER BY doc_id LIMIT 5
        """,
    ),
    "sample_tickets": (
        sample_tickets,
        """
        SELECT o_orderkey AS id FROM orders
        ORDER BY md5('0-' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100
        """,
    ),
}
