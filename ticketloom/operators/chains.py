"""The order of fetched pages: every page's place in its chain of cursors, and what is wrong with the chains.

A page names the next one, so its place is known only from the page before it. Places
are found by pointer jumping: in round ``k`` every page knows the page ``2 ** k`` steps
ahead and hands it the place it has so far. A chain of a million pages takes twenty
rounds of joins, and none of its pages are gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import nested
from ticketloom.operators.joins import join_many_to_one
from ticketloom.session import staged

GAP, FORK, LOOP, MERGE, DETACHED = "gap", "fork", "loop", "merge", "detached"

# A place and the page it is counted from as one number, the page first: aggregates of numbers are hashed.
_PLACES = 10**18
_AFTER_FIRST = 1 << 62
_NUMBER = "decimal(38,0)"


class PageOrder(NamedTuple):
    """``places``: the chain's columns, cursor, piece, place; ``faults``: the chain's columns,
    kind, cursor, following."""

    places: DataFrame
    faults: DataFrame


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    match = F.lit(True)
    for a, b in zip(left, right, strict=True):
        match = match & F.col(a).eqNullSafe(F.col(b))
    return match


def page_order(
    pages: DataFrame,
    chain: Sequence[str] = (),
    cursor: Column | None = None,
    following: Column | None = None,
) -> PageOrder:
    """Places of the landed pages in their chains, and the chains' faults.

    ``chain`` names the columns that tell several chains apart (none: all pages are one);
    a page was requested with ``cursor`` (NULL or '': the first page) and names
    ``following`` (NULL or '': the last page). A page landed again is one page.

    A page's ``piece`` is NULL if the chain's first page leads to it, else the cursor where
    its piece begins; ``place`` counts from 0 along the piece. Faults are

    - ``gap``: ``following`` never landed,
    - ``fork``: the page landed with several followers; the smallest counts, the others are listed,
    - ``loop``: ``following`` is an earlier page of the piece, or both lie on a ring that nothing
      leads into; pages of a ring have no place,
    - ``merge``: ``following`` belongs to another piece, the one that begins with the first page
      or, without one, at the smallest cursor,
    - ``detached``: a piece begins at ``cursor``, to which no page leads.
    """
    at = F.col("after") if cursor is None else cursor
    to = nested.next_cursor(F.col("paging")) if following is None else F.nullif(following, F.lit(""))
    steps = staged(
        pages.select(
            *[F.col(c).alias(f"chain_{k}") for k, c in enumerate(chain)],
            F.coalesce(at, F.lit("")).alias("cursor"),
            to.alias("following"),
        ).distinct(),
        "page-steps",
    )
    keys = [f"chain_{k}" for k in range(len(chain))]
    nodes = steps.groupBy(*keys, "cursor").agg(F.min("following").alias("following"))
    ordered = nodes.repartitionByRange(*keys, "cursor").sortWithinPartitions(*keys, "cursor")
    # Numbers ascend with the cursor, so the smallest number is the smallest cursor.
    nodes = staged(ordered.withColumn("id", F.monotonically_increasing_id()), "pages-numbered")

    target = nodes.select(*[F.col(k).alias(f"to_{k}") for k in keys], F.col("cursor").alias("to_cursor"), F.col("id").alias("to"))
    meets = _same([*keys, "following"], [*(f"to_{k}" for k in keys), "to_cursor"])
    linked = nodes.where("following IS NOT NULL").join(target, meets, "left").select(*nodes.columns, "to")
    links = staged(linked.unionByName(nodes.where("following IS NULL").withColumn("to", F.lit(None).cast("bigint"))), "page-links")
    first = F.col("cursor") == ""
    led_to = links.where("to IS NOT NULL").select(F.col("to").alias("led_to")).distinct()
    heads = (
        links.join(led_to, F.col("id") == F.col("led_to"), "left")
        .where(first | F.col("led_to").isNull())
        .select(F.col("id").alias("head"), "cursor")
    )
    # A first page's number as it is, a detached piece's after all of those.
    begins = (F.col("head") + F.when(first, 0).otherwise(_AFTER_FIRST)).cast(_NUMBER) * F.lit(_PLACES)
    start = links.select("id", F.col("to").alias("jump")).join(
        heads.select(F.col("head").alias("head_id"), begins.cast(_NUMBER).alias("best")), F.col("id") == F.col("head_id"), "left"
    )
    best = _ranked(start.select("id", "jump", "best"))

    ranks = best.select(
        F.col("id").alias("rank_id"),
        F.expr(f"best div {_PLACES}").alias("from"),
        F.expr(f"cast(best % {_PLACES} AS bigint)").alias("place"),
    )
    found = staged(links.join(ranks, F.col("id") == F.col("rank_id")).drop("rank_id"), "page-places")
    return PageOrder(_places(found, heads, keys, chain), _faults(steps, found, keys, chain))


def _ranked(state: DataFrame) -> DataFrame:
    """``(id, best)``: the smallest place that a piece's beginning gives each page, NULL on closed rings.

    Ends when a round improves nothing: then no longer jump would either. The joins are
    never broadcast: a table just below the threshold would pass the driver in every round.
    """
    state = staged(state, "page-ranks")
    step, before = 1, _progress(state)
    while not state.where("jump IS NOT NULL").isEmpty():
        ahead = state.select(F.col("id").alias("ahead"), F.col("jump").alias("further")).hint("merge")
        moved = state.where("jump IS NOT NULL").join(ahead, F.col("jump") == F.col("ahead"))
        own = F.struct("id", F.col("further").alias("jump"), "best")
        handed = F.struct(
            F.col("ahead").alias("id"),
            F.lit(None).cast("bigint").alias("jump"),
            (F.col("best") + F.lit(step)).cast(_NUMBER).alias("best"),
        )
        # Most pages have no place yet in most rounds: only those that have one hand it on.
        sent = F.when(F.col("best").isNull(), F.array(own)).otherwise(F.array(own, handed))
        rows = moved.select(F.inline(sent)).unionByName(state.where("jump IS NULL"))
        merged = rows.groupBy("id").agg(F.max("jump").alias("jump"), F.min("best").alias("best"))
        state = staged(merged, "page-ranks")
        after = _progress(state)
        if after == before:
            break
        step, before = step * 2, after
    return state.select("id", "best")


def _progress(state: DataFrame) -> tuple:
    """Changes with every improvement: more pages have a place, or, among as many, the pages places
    are counted from get smaller, or, from the same ones, the places do."""
    parts = [F.sum(F.expr(f"cast(best {part} {_PLACES} AS decimal(20,0))")) for part in ("div", "%")]
    return tuple(state.agg(F.count("best"), *parts).first())


def _named(chain: Sequence[str], keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(c) for k, c in zip(keys, chain, strict=True)]


def _places(found: DataFrame, heads: DataFrame, keys: Sequence[str], chain: Sequence[str]) -> DataFrame:
    """With the name of its beginning for each page of a detached piece; such a piece may hold most pages."""
    cursor = F.nullif("cursor", F.lit(""))
    whole = found.where(f"`from` IS NULL OR `from` < {_AFTER_FIRST}")
    whole = whole.select(*_named(chain, keys), cursor.alias("cursor"), F.lit(None).cast("string").alias("piece"), "place")
    pieces = heads.where("cursor <> ''").select((F.col("head") + _AFTER_FIRST).alias("head"), F.col("cursor").alias("piece"))
    loose = found.where(f"`from` >= {_AFTER_FIRST}")
    named = join_many_to_one(loose, pieces, "from", "head")
    return whole.unionByName(named.select(*_named(chain, keys), cursor.alias("cursor"), "piece", "place"))


def _faults(steps: DataFrame, found: DataFrame, keys: Sequence[str], chain: Sequence[str]) -> DataFrame:
    def rows(df: DataFrame, kind: str | Column, following: Column) -> DataFrame:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return df.select(
            *_named(chain, keys), kind.alias("kind"), F.nullif("cursor", F.lit("")).alias("cursor"), following.alias("following")
        )

    following, nothing = F.col("following"), F.lit(None).cast("string")
    node = found.select(
        *[F.col(k).alias(f"node_{k}") for k in keys], F.col("cursor").alias("node"), F.col("following").alias("chosen")
    )
    is_landed = _same([*keys, "following"], [*(f"node_{k}" for k in keys), "node"])
    is_own = _same([*keys, "cursor"], [*(f"node_{k}" for k in keys), "node"])
    named = steps.where("following IS NOT NULL")
    gaps = rows(named.join(node, is_landed, "left_anti"), GAP, following)
    forks = rows(named.join(node, is_own & (F.col("following") != F.col("chosen")), "left_semi"), FORK, following)
    ends = found.select(F.col("id").alias("end"), F.col("from").alias("end_from"), F.col("place").alias("end_place"))
    meet = found.where("to IS NOT NULL").join(ends, F.col("to") == F.col("end"))
    kind = (
        F.when(F.col("from").isNull(), LOOP)
        .when(F.col("from") != F.col("end_from"), MERGE)
        .when(F.col("end_place") <= F.col("place"), LOOP)
    )
    crossed = rows(meet.where(kind.isNotNull()), kind, following)
    detached = rows(found.where(f"`from` >= {_AFTER_FIRST} AND place = 0"), DETACHED, nothing)
    return gaps.unionByName(forks).unionByName(crossed).unionByName(detached)


def ordered_tickets(
    pages: DataFrame, places: DataFrame, chain: Sequence[str] = (), cursor: Column | None = None
) -> DataFrame:
    """Tickets in the order they were fetched: the chain's columns, piece, page, place, id, properties.

    ``page`` is the page's place in its piece and ``place`` the ticket's in its page, so
    sorting by both gives the order in which a reader of the pages would append them.
    Of a page that landed with different contents one counts; archived tickets are left out.
    """
    at = F.coalesce(F.col("after") if cursor is None else cursor, F.lit(""))
    one = (
        pages.groupBy(*[F.col(c).alias(f"page_{k}") for k, c in enumerate(chain)], at.alias("page_cursor"))
        .agg(F.max_by("results", F.xxhash64(F.to_json("results"))).alias("results"))
    )
    own = [*(f"page_{k}" for k in range(len(chain))), "page_cursor"]
    placed = places.withColumnsRenamed({"place": "page"}).withColumn("key", F.coalesce("cursor", F.lit("")))
    return (
        placed.join(one, _same([*chain, "key"], own))
        .select(*chain, "piece", "page", F.posexplode("results").alias("place", "ticket"))
        .where(~F.coalesce(F.col("ticket.archived"), F.lit(False)))
        .select(*chain, "piece", "page", "place", "ticket.id", "ticket.properties")
    )
