"""Merge, counts, first association, subject comparison and e-mail expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators import associations as ops
from ticketloom.operators import compare
from ticketloom.plans.associations import expand_emails
from ticketloom.plans.subjects import compare_subjects
from ticketloom.workload.tables import (
    EDGE_ORDER,
    EDGE_TIES,
    edges,
    subject_tickets,
    supplier_emails,
    table,
    thread_edges,
    thread_emails,
    tickets,
)


# Small enough for the hot keys of the skewed queries to be split at every scale.
SKEWED_SHARE = 10


def left_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = ops.merge_associations(tickets(spark, sf_dir), edges(spark, sf_dir))
    return merged.withColumns(
        {"id": F.col("id").cast("string"), "ticket_id": F.col("ticket_id").cast("string")}
    )


def tickets_without_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.tickets_without_association(tickets(spark, sf_dir), edges(spark, sf_dir))


def null_associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.null_associations(tickets(spark, sf_dir), edges(spark, sf_dir))


def association_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.association_counts(tickets(spark, sf_dir), edges(spark, sf_dir))


def association_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.association_histogram(association_counts(spark, sf_dir))


def first_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.first_association(edges(spark, sf_dir), EDGE_ORDER, EDGE_TIES)


def associations_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.associations_topk(edges(spark, sf_dir), 3, EDGE_ORDER, EDGE_TIES)


def first_email_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.first_email_compare(
        subject_tickets(spark, sf_dir),
        edges(spark, sf_dir),
        supplier_emails(spark, sf_dir),
        EDGE_ORDER,
        EDGE_TIES,
    )


def subject_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.subject_matches(first_email_compare(spark, sf_dir)).select(
        "ticket_id", "ticket_subject", "email_subject"
    )


def subject_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.subject_mismatches(first_email_compare(spark, sf_dir)).select(
        "ticket_id", "ticket_subject", "email_subject"
    )


def subject_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.subject_match_rate(first_email_compare(spark, sf_dir))


def sampled_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_subjects(
        subject_tickets(spark, sf_dir),
        edges(spark, sf_dir),
        supplier_emails(spark, sf_dir),
        order_by=EDGE_ORDER,
        ties=EDGE_TIES,
    ).match_rate


def ticket_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ticket_emails(thread_edges(spark, sf_dir), thread_emails(spark, sf_dir))


def unresolved_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unresolved_emails(thread_edges(spark, sf_dir), thread_emails(spark, sf_dir))


def emails_per_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    threads = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id")).distinct()
    return ops.emails_per_ticket(threads, ticket_emails(spark, sf_dir))


def _skewed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges, of which those of line 1 belong to one ticket and those of line 2 to none."""
    number = F.col("pos")
    ticket = F.when(number == 1, F.lit(77)).when(number == 2, F.lit(None)).otherwise(F.col("ticket_id"))
    return edges(spark, sf_dir).withColumn("ticket_id", ticket.cast("bigint"))


def left_merge_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.merge_associations(
        tickets(spark, sf_dir), _skewed_edges(spark, sf_dir), rows_per_share=SKEWED_SHARE
    )


def topk_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than Spark's own group limit takes."""
    return ops.associations_topk(
        _skewed_edges(spark, sf_dir), 1500, EDGE_ORDER, EDGE_TIES, rows_per_share=SKEWED_SHARE
    )


def _skewed_thread_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thread's edges, of which the first turns lead to one e-mail and the third ones nowhere."""
    turn = F.element_at(F.split("association_id", "-"), -1)
    target = F.when(turn == "1", F.lit("1-1")).when(turn == "3", F.lit(None)).otherwise(F.col("association_id"))
    return thread_edges(spark, sf_dir).withColumn("association_id", target)


def ticket_emails_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ticket_emails(
        _skewed_thread_edges(spark, sf_dir), thread_emails(spark, sf_dir), rows_per_share=SKEWED_SHARE
    )


def unresolved_emails_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unresolved_emails(
        _skewed_thread_edges(spark, sf_dir), thread_emails(spark, sf_dir), rows_per_share=SKEWED_SHARE
    )


def expanded_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The e-mails of the threads that a system turn opens."""
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "system")
    threads = turns.select(F.col("conv_id").alias("id")).distinct()
    return expand_emails(threads, thread_edges(spark, sf_dir), thread_emails(spark, sf_dir)).emails


_EDGES = """
    SELECT l_orderkey AS ticket_id, l_suppkey AS association_id, l_returnflag AS association_type,
           l_linestatus AS association_category, CAST(l_linenumber AS BIGINT) AS pos,
           l_partkey AS part_id
    FROM lineitem
"""
_TICKETS = "SELECT o_orderkey AS id, o_orderstatus, o_orderpriority, o_orderdate FROM orders"
_RANKED = f"""
    SELECT *, row_number() OVER (
        PARTITION BY ticket_id
        ORDER BY pos, part_id, association_id, association_type, association_category) AS "rank"
    FROM ({_EDGES})
"""
_COUNTS = f"""
    SELECT ticket_id, count(association_id) AS n_associations
    FROM ({_TICKETS}) LEFT JOIN ({_EDGES}) ON id = ticket_id
    WHERE ticket_id IS NOT NULL GROUP BY ticket_id
"""
_COMPARISON = f"""
    SELECT ticket_id, ticket_subject, email_subject, email_text,
           '<p>' || email_text || '</p>' AS email_html
    FROM (SELECT * FROM ({_RANKED}) WHERE "rank" = 1)
    JOIN (SELECT o_orderkey, min(subject) AS ticket_subject
          FROM orders LEFT JOIN (
              SELECT c_custkey, min(CAST(c_nationkey AS VARCHAR)) AS subject
              FROM customer GROUP BY c_custkey) ON c_custkey = o_custkey
          GROUP BY o_orderkey) ON o_orderkey = ticket_id
    JOIN (SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS email_subject, s_name AS email_text
          FROM supplier
          QUALIFY row_number() OVER (PARTITION BY s_suppkey
              ORDER BY CAST(s_nationkey AS VARCHAR) NULLS FIRST, s_name NULLS FIRST) = 1)
      ON s_suppkey = association_id
"""
_MATCH = "coalesce(ticket_subject = email_subject, false)"
_RATE = f"""
    SELECT count(*) AS n_compared, count(*) FILTER ({_MATCH}) AS n_matches,
           round(100.0::DOUBLE * count(*) FILTER ({_MATCH}) / nullif(count(*), 0), 2) AS match_pct
"""
_THREAD_EDGES = """
    SELECT conv_id AS ticket_id, conv_id || '-' || (turn + 1) AS association_id
    FROM conversations WHERE role = 'user'
"""
_THREAD_EMAILS = """
    SELECT conv_id || '-' || turn AS id, 'Re: ' || conv_id AS subject, text AS content,
           CAST(turn AS VARCHAR) AS timestamp
    FROM conversations WHERE role = 'assistant'
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) = 1
"""
_THREAD = f"""
    SELECT ticket_id, association_id, subject, content, timestamp
    FROM ({_THREAD_EDGES}) JOIN ({_THREAD_EMAILS}) ON association_id = id
"""

_SKEWED = f"""
    SELECT * REPLACE (CASE pos WHEN 1 THEN 77 WHEN 2 THEN NULL ELSE ticket_id END AS ticket_id) FROM ({_EDGES})
"""
_SKEWED_THREAD = f"""
    SELECT ticket_id, CASE string_split(association_id, '-')[-1]
        WHEN '1' THEN '1-1' WHEN '3' THEN NULL ELSE association_id END AS association_id
    FROM ({_THREAD_EDGES})
"""

QUERIES = {
    "left_merge_skewed": (
        left_merge_skewed,
        f"SELECT * FROM ({_TICKETS}) LEFT JOIN ({_SKEWED}) ON id = ticket_id",
    ),
    "topk_skewed": (
        topk_skewed,
        f"""
        SELECT *, row_number() OVER (
            PARTITION BY ticket_id
            ORDER BY pos, part_id, association_id, association_type, association_category) AS "rank"
        FROM ({_SKEWED}) QUALIFY "rank" <= 1500
        """,
    ),
    "ticket_emails_skewed": (
        ticket_emails_skewed,
        f"""
        SELECT ticket_id, association_id, subject, content, timestamp
        FROM ({_SKEWED_THREAD}) JOIN ({_THREAD_EMAILS}) ON association_id = id
        """,
    ),
    "unresolved_emails_skewed": (
        unresolved_emails_skewed,
        f"""
        SELECT ticket_id, association_id FROM ({_SKEWED_THREAD})
        WHERE association_id IS NULL OR association_id NOT IN (SELECT id FROM ({_THREAD_EMAILS}))
        """,
    ),
    "expanded_emails": (
        expanded_emails,
        f"{_THREAD} WHERE ticket_id IN (SELECT conv_id FROM conversations WHERE role = 'system')",
    ),
    "left_merge": (
        left_merge,
        f"""
        SELECT CAST(id AS VARCHAR) AS id, o_orderstatus, o_orderpriority, o_orderdate,
               CAST(ticket_id AS VARCHAR) AS ticket_id, association_id, association_type,
               association_category, pos, part_id
        FROM ({_TICKETS}) LEFT JOIN ({_EDGES}) ON id = ticket_id
        """,
    ),
    "tickets_without_association": (
        tickets_without_association,
        f"""
        SELECT * FROM ({_TICKETS})
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = id)
        """,
    ),
    "null_associations": (
        null_associations,
        f"""
        SELECT null_rows, n_tickets,
               round(100.0::DOUBLE * null_rows / nullif(n_tickets, 0), 2) AS null_pct
        FROM (SELECT count(*) FILTER (association_id IS NULL) AS null_rows,
                     (SELECT count(*) FROM orders) AS n_tickets
              FROM ({_TICKETS}) LEFT JOIN ({_EDGES}) ON id = ticket_id)
        """,
    ),
    "association_counts": (association_counts, _COUNTS),
    "association_histogram": (
        association_histogram,
        f"""
        SELECT n_associations, count(*) AS n_tickets FROM ({_COUNTS})
        GROUP BY n_associations ORDER BY n_associations
        """,
    ),
    "first_association": (
        first_association,
        f"""
        SELECT ticket_id, association_id, association_type, association_category, pos, part_id
        FROM ({_RANKED}) WHERE "rank" = 1
        """,
    ),
    "associations_topk": (associations_topk, f'SELECT * FROM ({_RANKED}) WHERE "rank" <= 3'),
    "first_email_compare": (first_email_compare, _COMPARISON),
    "subject_matches": (
        subject_matches,
        f"SELECT ticket_id, ticket_subject, email_subject FROM ({_COMPARISON}) WHERE {_MATCH}",
    ),
    "subject_mismatches": (
        subject_mismatches,
        f"SELECT ticket_id, ticket_subject, email_subject FROM ({_COMPARISON}) WHERE NOT {_MATCH}",
    ),
    "subject_match_rate": (subject_match_rate, f"{_RATE} FROM ({_COMPARISON})"),
    "sampled_match_rate": (
        sampled_match_rate,
        f"""
        {_RATE} FROM ({_COMPARISON}) WHERE ticket_id IN (
            SELECT o_orderkey FROM orders
            ORDER BY md5('0-' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100)
        """,
    ),
    "ticket_emails": (ticket_emails, _THREAD),
    "unresolved_emails": (
        unresolved_emails,
        f"""
        SELECT ticket_id, association_id FROM ({_THREAD_EDGES})
        WHERE association_id NOT IN (SELECT id FROM ({_THREAD_EMAILS}))
        """,
    ),
    "emails_per_ticket": (
        emails_per_ticket,
        f"""
        SELECT t.conv_id AS ticket_id, count(e.ticket_id) AS n_emails
        FROM (SELECT DISTINCT conv_id FROM conversations) t
        LEFT JOIN ({_THREAD}) e ON e.ticket_id = t.conv_id GROUP BY t.conv_id
        """,
    ),
}
