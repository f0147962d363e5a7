"""Orders as pages that were fetched in several runs, one per priority, some of them out of step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.operators.chains import PageOrder, ordered_tickets, page_order
from ticketloom.workload.tables import table

PER_PAGE = 50


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per order: it names the next order of its priority, but for some numbers a page that
    never landed or one three pages back; some pages landed again naming the page after the
    next, and some pages lie on a ring of their own."""
    run = Window.partitionBy("o_orderpriority").orderBy("o_orderkey")
    key = F.col("o_orderkey")

    def other(k: int) -> Column:
        return F.lead("o_orderkey", k).over(run).cast("string")

    pages = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run"),
        key.alias("key"),
        F.when(F.lag("o_orderkey", 1).over(run).isNotNull(), key.cast("string")).alias("after"),
        other(1).alias("next"),
        other(2).alias("later"),
        F.when(F.lag("o_orderkey", 4).over(run).isNotNull(), F.lag("o_orderkey", 3).over(run).cast("string")).alias("back"),
    )
    key = F.col("key")
    following = (
        F.when(key % 997 == 5, F.concat(F.lit("gone-"), key.cast("string")))
        .when((key % 1499 == 7) & F.col("back").isNotNull(), F.col("back"))
        .otherwise(F.col("next"))
    )
    ring = F.concat(F.lit("ring-"), key.cast("string"))
    landed = F.array(
        F.struct(F.col("after").alias("after"), following.alias("following")),
        F.when(key % 1201 == 3, F.struct(F.col("after").alias("after"), F.col("later").alias("following"))),
        F.when(key % 1301 == 11, F.struct(ring.alias("after"), ring.alias("following"))),
    )
    return pages.select("run", F.explode(landed).alias("page")).where("page IS NOT NULL").select("run", "page.*")


def _order(spark: SparkSession, sf_dir: str) -> PageOrder:
    return page_order(_runs(spark, sf_dir), ["run"], F.col("after"), F.col("following"))


def page_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order(spark, sf_dir).places


def page_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order(spark, sf_dir).faults


def tickets_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of up to 50 orders, each run's in ascending order from the last page to the first."""
    number = F.floor(F.col("o_orderkey") / PER_PAGE)
    ticket = F.struct(F.col("o_orderkey").alias("key"), (F.col("o_orderstatus") == "P").alias("archived"))
    pages = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("run"), number.alias("number"))
        .agg(F.array_sort(F.collect_list(ticket)).alias("orders"))
    )
    run = Window.partitionBy("run").orderBy(F.desc("number"))
    results = F.transform(
        "orders",
        lambda o: F.struct(
            o["key"].cast("string").alias("id"),
            F.create_map(F.lit("id"), o["key"].cast("string")).alias("properties"),
            o["archived"].alias("archived"),
        ),
    )
    chained = pages.select(
        "run",
        F.when(F.lag("number").over(run).isNotNull(), F.col("number").cast("string")).alias("after"),
        F.lead("number").over(run).cast("string").alias("following"),
        results.alias("results"),
    )
    places = page_order(chained, ["run"], F.col("after"), F.col("following")).places
    return ordered_tickets(chained, places, ["run"]).drop("properties")


_RUNS = """
    keyed AS (
      SELECT o_orderpriority AS run, o_orderkey AS key,
        CASE WHEN lag(o_orderkey) OVER w IS NOT NULL THEN o_orderkey::VARCHAR ELSE '' END AS node,
        lead(o_orderkey) OVER w AS next, lead(o_orderkey, 2) OVER w AS later,
        CASE WHEN lag(o_orderkey, 4) OVER w IS NOT NULL THEN lag(o_orderkey, 3) OVER w END AS back
      FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey)
    ), landed AS (
      SELECT run, node, CASE WHEN key % 997 = 5 THEN 'gone-' || key
        WHEN key % 1499 = 7 AND back IS NOT NULL THEN back::VARCHAR ELSE next::VARCHAR END AS following FROM keyed
      UNION ALL SELECT run, node, later::VARCHAR FROM keyed WHERE key % 1201 = 3
      UNION ALL SELECT run, 'ring-' || key, 'ring-' || key FROM keyed WHERE key % 1301 = 11
    ), nodes AS (
      SELECT run, node, min(following) AS following FROM landed GROUP BY run, node
    ), heads AS (
      SELECT run, node FROM nodes n WHERE node = ''
      UNION ALL
      SELECT n.run, n.node FROM nodes n LEFT JOIN nodes p ON p.run = n.run AND p.following = n.node
      WHERE p.node IS NULL AND n.node <> ''
    ), sizes AS (
      SELECT run, count(*) AS n FROM nodes GROUP BY run
    ), walk AS (
      SELECT run, node, node AS head, 0::BIGINT AS place FROM heads
      UNION ALL
      SELECT w.run, t.node, w.head, w.place + 1
      FROM walk w JOIN nodes f ON f.run = w.run AND f.node = w.node
      JOIN nodes t ON t.run = f.run AND t.node = f.following
      JOIN sizes s ON s.run = w.run WHERE w.place < s.n
    ), placed AS (
      SELECT n.run, n.node, n.following, w.head, w.place FROM nodes n LEFT JOIN (
        SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY run, node ORDER BY head <> '', head, place) = 1
      ) w ON w.run = n.run AND w.node = n.node
    )
"""

QUERIES = {
    "page_places": (
        page_places,
        f"WITH RECURSIVE {_RUNS} SELECT run, nullif(node, '') AS cursor, nullif(head, '') AS piece, place FROM placed",
    ),
    "page_faults": (
        page_faults,
        f"""
        WITH RECURSIVE {_RUNS}
        SELECT DISTINCT run, kind, nullif(cursor, '') AS cursor, following FROM (
          SELECT l.run, 'gap' AS kind, l.node AS cursor, l.following FROM landed l
          LEFT JOIN nodes n ON n.run = l.run AND n.node = l.following
          WHERE l.following IS NOT NULL AND n.node IS NULL
          UNION ALL
          SELECT l.run, 'fork', l.node, l.following FROM landed l
          JOIN nodes n ON n.run = l.run AND n.node = l.node WHERE l.following <> n.following
          UNION ALL
          SELECT p.run, CASE WHEN p.head = t.head OR p.head IS NULL THEN 'loop' ELSE 'merge' END, p.node, p.following
          FROM placed p JOIN placed t ON t.run = p.run AND t.node = p.following
          WHERE p.head IS NULL OR p.head <> t.head OR t.place <= p.place
          UNION ALL
          SELECT run, 'detached', head, NULL FROM placed WHERE head <> '' AND place = 0
        )
        """,
    ),
    "tickets_in_order": (
        tickets_in_order,
        f"""
        WITH paged AS (
          SELECT o_orderpriority AS run, o_orderkey // {PER_PAGE} AS number, o_orderkey, o_orderstatus FROM orders
        )
        SELECT run, NULL::VARCHAR AS piece, id, page, place FROM (
          SELECT run, o_orderkey::VARCHAR AS id, o_orderstatus,
            dense_rank() OVER (PARTITION BY run ORDER BY number DESC) - 1 AS page,
            (row_number() OVER (PARTITION BY run, number ORDER BY o_orderkey) - 1)::INT AS place
          FROM paged
        ) WHERE o_orderstatus <> 'P'
        """,
    ),
}
