"""URL filters as a sort-merge range join, in DataFrame operations only.

A host is read label by label from its end, so that a rule's host and all its
subdomains are one interval of keys. Rule intervals nest; their ends cut the key line
into segments, each with the stack of rules that are open there. URLs are sorted in
among the segments' first keys and take the stack of the last one before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.llm.shared import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SWEEP_ROWS = 10_000


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``; the empty host is ``.``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _segments(rules: DataFrame) -> DataFrame:
    """``(key, stack)``: the rules that are open from a key to the next one.

    At a rule's first key those of its host and of the hosts above are open, after its
    last key only those of the hosts above.
    """
    keyed = rules.select(
        host_key(F.col("host")).alias("key"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.concat("host", "path").alias("rule"),
            "path",
            "verdict",
        ).alias("entry"),
    ).distinct()
    labels = F.split(F.expr("left(key, length(key) - 1)"), r"\.", -1)
    hosts = keyed.select("key").distinct().select("key", labels.alias("labels"))
    above = hosts.select(
        "key",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("labels")),
                lambda n: F.concat(F.array_join(F.slice("labels", 1, n), "."), F.lit(".")),
            )
        ).alias("open"),
    )
    of_open = keyed.select(F.col("key").alias("open"), "entry")
    opened = above.join(of_open, "open", "left")
    after = F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/"))
    stack = F.collect_list("entry").alias("stack")
    return (
        opened.groupBy("key")
        .agg(stack)
        .unionAll(opened.where("open <> key").groupBy(after.alias("key")).agg(stack))
        .unionAll(
            hosts.where("size(labels) = 1").select(
                after.alias("key"), F.lit(None).cast(keyed.schema["entry"].dataType).alias("entry")
            ).groupBy("key").agg(stack)
        )
    )


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages``.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if the
    path starts with its own; the one with the most characters wins, then the greater
    text. Without a fitting rule ``rule`` is NULL and ``verdict`` the default. A NULL
    url or one without ``://`` has an empty host and path. Rules with a NULL are left
    out and repeated ones count once. Other columns are ignored; repeated rows are
    judged alike.

    URLs are dealt evenly into sweeps, whatever their host, so a hot host is spread;
    every sweep has a copy of the segments and at least ten times as many URLs as
    segments, so the copies stay below a tenth of the rows.
    """
    url = F.col(url_column).cast("string")
    rows = pages.select(
        F.col(id_column).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path")
    )
    clean = rules.select("host", "path", "verdict").dropna()
    segments = checkpointed(_segments(clean.withColumn("host", F.translate("host", UPPER, LOWER))))
    size = max(SWEEP_ROWS, 10 * segments.count())
    n = max(1, -(-pages.count() // size))
    copies = segments.select(
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("sweep"),
        "key",
        F.lit(0).alias("kind"),
        "stack",
        F.lit(None).cast(rows.schema["page_id"].dataType).alias("page_id"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
    )
    urls = rows.select(
        F.pmod(F.xxhash64("page_id", "path", F.monotonically_increasing_id()), F.lit(n)).cast("int").alias("sweep"),
        host_key(F.col("host")).alias("key"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(segments.schema["stack"].dataType).alias("stack"),
        "page_id",
        "host",
        "path",
    )
    order = Window.partitionBy("sweep").orderBy("key", "kind")
    last = F.last("stack", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    fitting = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]))
    return (
        copies.unionAll(urls)
        .select("*", last.alias("open"))
        .where("kind = 1")
        .select("page_id", "host", "path", F.array_max(fitting).alias("best"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
