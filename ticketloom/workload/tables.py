"""The stand-in tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators.associations import one_per_id
from ticketloom.operators.joins import join_many_to_one
from ticketloom.sources.tables import read_table

# The window queries end on the last day of the orders table.
AS_OF = "2001-08-01"
EDGE_ORDER = ("pos",)
EDGE_TIES = ("part_id", "association_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority", "o_orderdate"
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Associations of an order: its suppliers, in line order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_suppkey").alias("association_id"),
        F.col("l_returnflag").alias("association_type"),
        F.col("l_linestatus").alias("association_category"),
        F.col("l_linenumber").cast("bigint").alias("pos"),
        F.col("l_partkey").alias("part_id"),
    )


def subject_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's nation as the subject."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    customers = one_per_id(
        table(spark, sf_dir, "customer").select(
            "c_custkey", F.col("c_nationkey").cast("string").alias("subject")
        ),
        "c_custkey",
    )
    return join_many_to_one(orders, customers, "o_custkey", "c_custkey", "left").select(
        "id", "subject"
    )


def supplier_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their nation as the subject."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").cast("string").alias("hs_email_subject"),
        F.col("s_name").alias("hs_email_text"),
        F.concat(F.lit("<p>"), F.col("s_name"), F.lit("</p>")).alias("hs_email_html"),
    )


def _turn_id(turn) -> F.Column:
    return F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))


def thread_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn of a conversation is associated with the turn that answers it."""
    return (
        table(spark, sf_dir, "conversations")
        .where(F.col("role") == "user")
        .select(F.col("conv_id").alias("ticket_id"), _turn_id(F.col("turn") + 1).alias("association_id"))
    )


def thread_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as e-mails."""
    return (
        table(spark, sf_dir, "conversations")
        .where(F.col("role") == "assistant")
        .select(
            _turn_id(F.col("turn")).alias("id"),
            F.concat(F.lit("Re: "), F.col("conv_id").cast("string")).alias("hs_email_subject"),
            F.col("text").alias("hs_email_text"),
            F.col("turn").cast("string").alias("hs_timestamp"),
        )
    )


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
