"""Similarity links among the members of hash buckets, without forming all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.components import components
from ticketloom.llm.shared import checkpointed, narrowed, saved, scratch

PROBES = 6
# Pairs verified at once: so many, or one for each set.
PAIRS = 1 << 17
AsSet = Callable[[Column], Column]


def similar(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * common >= percent * (n_a + n_b - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int, members: AsSet) -> DataFrame:
    """The pairs ``(a, b)`` whose sets ``(id, n, content)`` have an intersection of
    ``percent`` of their union or more. Set sizes rule pairs out before contents are sent.

    Contents are sent for about as many pairs at a time as there are sets, so that what is
    shuffled at once grows with the sets, however many pairs there are.
    """
    sizes = sets.select("id", "n")
    sized = checkpointed(
        pairs.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a")
        .join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
        .where(similar(F.least("na", "nb"), F.col("na"), F.col("nb"), percent))
        .select("a", "b", "na", "nb")
    )
    common = F.size(F.array_intersect(members(F.col("sa")), members(F.col("sb")))).cast("bigint")
    turns = -(-sized.count() // max(PAIRS, sets.count())) or 1

    def links(some: DataFrame) -> DataFrame:
        return (
            some.join(sets.select(F.col("id").alias("a"), F.col("content").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("content").alias("sb")), "b")
            .where(similar(common, F.col("na"), F.col("nb"), percent))
            .select("a", "b")
        )

    if turns == 1:
        return links(sized)
    turn = F.pmod(F.xxhash64("a", "b"), F.lit(turns))
    return reduce(DataFrame.unionAll, [checkpointed(links(sized.where(turn == k))) for k in range(turns)])


def linked_components(
    buckets: Sequence[DataFrame],
    tokens: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    known: DataFrame,
    percent: int,
    members: AsSet = lambda content: content,
) -> DataFrame:
    """``(node, component)`` over ``known`` links ``(a, b)`` and those among members of a bucket.

    ``buckets(key, id)`` names the candidates: members of one bucket. There may be several of
    these tables, without a key in common; they are dealt by key one after the other, as most
    keys have one member, which is let go. ``tokens(id, keys,
    others)`` says the same of two ids: they are bucket mates if they share one of
    ``keys`` and, unless it is NULL, one of ``others``. ``sets_of(ids)`` gives ``(id, n,
    content)``, and ``members(content)`` the array of the ``n`` members of a set. First every member is compared with the smallest of its bucket mates'
    least members, then with ``PROBES`` mates drawn by hash that are not in its group
    yet: a few comparisons a member, however large a bucket. Mates that are then still
    in different components are compared pair by pair. So no link between components is
    lost.
    """
    with scratch(known.sparkSession) as folder:
        parts = [saved(_shared(b), "bucket-members", f"{folder}/bucket-members-{k}") for k, b in enumerate(buckets)]
        in_use = reduce(DataFrame.unionAll, parts)
        least = checkpointed(in_use.groupBy("id").agg(F.min("rep").alias("rep")))
        sets = saved(sets_of(least.select("id")), "shingle-sets", f"{folder}/shingle-sets")
        stars = least.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
        links = checkpointed(verified(stars, sets, percent, members))
        mates = in_use.select("key", "id")
        probes = checkpointed(_probes(mates, links, folder).join(stars, ["a", "b"], "left_anti"))
        links = checkpointed(links.unionAll(verified(probes, sets, percent, members)).unionAll(known))
        parts = components(links)
        crossing = _crossing(mates, parts, tokens, least, sets, percent, members, folder)
        pairs = saved(crossing, "pairs", f"{folder}/pairs")
        open_pairs = pairs.where("NOT linked").select("a", "b").join(stars.unionAll(probes), ["a", "b"], "left_anti")
        sure = pairs.where("linked").select("a", "b")
        more = checkpointed(verified(checkpointed(open_pairs), sets, percent, members).unionAll(sure))
        return parts if more.isEmpty() else components(links.unionAll(more))


def _shared(buckets: DataFrame) -> DataFrame:
    """``(key, id, rep)``: the members of the buckets that have several, and the smallest of each."""
    of_key = Window.partitionBy("key")
    ends = buckets.select("key", "id", F.min("id").over(of_key).alias("rep"), F.max("id").over(of_key).alias("other"))
    return ends.where("rep <> other").drop("other")


def _named(members: DataFrame, names: DataFrame) -> DataFrame:
    """``members(key, id)`` with the name of each id in ``names(id, name)``, or else the id."""
    return members.join(names, "id", "left").select("key", "id", F.coalesce("name", "id").alias("name"))


def _open_keys(named: DataFrame, *more: Column) -> DataFrame:
    """The keys whose members have different names."""
    ends = [F.min("name").alias("low"), F.max("name").alias("high")]
    return named.groupBy("key").agg(*ends, *more).where("low <> high").drop("low", "high")


def _probes(members: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """For every member of a bucket that is not one group yet, a few mates of other groups.

    A group is a smallest member with those verified to be like it. Of all the mates
    drawn from its buckets a member is compared with ``PROBES``.
    """
    named = saved(_named(members, links.select(F.col("b").alias("id"), F.col("a").alias("name"))), "grouped", f"{folder}/grouped")
    drawn = [F.min_by(F.struct("id", "name"), F.xxhash64("id", F.lit(k))) for k in range(PROBES)]
    chosen = checkpointed(_open_keys(named, F.array(*drawn).alias("probes")))
    mate = F.col("mate.id")
    return (
        named.join(chosen, "key")
        .select("id", "name", F.posexplode("probes").alias("turn", "mate"))
        .where("name <> mate.name")
        .groupBy("id", "turn")
        .agg(F.min_by(mate, F.xxhash64(mate, "turn")).alias("mate"))
        .select(F.least("id", "mate").alias("a"), F.greatest("id", "mate").alias("b"))
        .distinct()
    )


def _differences(ids: DataFrame, least: DataFrame, sets: DataFrame, members: AsSet) -> DataFrame:
    """``(id, rep, difference)``: what of a set and of its representative's is in one of them only.

    NULL where that is more than half of the set, so a set is never sent twice over.
    """
    of_rep = sets.select(F.col("id").alias("rep"), F.col("content").alias("of_rep"))
    own, other = members(F.col("content")), members(F.col("of_rep"))
    both = F.concat(F.array_except(own, other), F.array_except(other, own))
    return (
        ids.select("id")
        .join(least, "id")
        .join(sets, "id")
        .join(of_rep, "rep")
        .select("id", "rep", "n", both.alias("difference"))
        .select("id", "rep", "n", F.when(2 * F.size("difference") <= F.col("n"), F.col("difference")).alias("difference"))
    )


def _crossing(
    mates: DataFrame,
    parts: DataFrame,
    tokens: DataFrame,
    least: DataFrame,
    sets: DataFrame,
    percent: int,
    members: AsSet,
    folder: str,
) -> DataFrame:
    """``(a, b, linked)``: bucket mates of different components, each pair once.

    Two sets differ in what their differences from a common representative do not share,
    so for mates with the same one the join itself decides, and only links come out. Other
    mates come out undecided if their sizes allow a link.
    """
    placed = parts.select(F.col("node").alias("id"), F.col("component").alias("name"))
    named = saved(_named(mates, placed), "placed", f"{folder}/placed")
    ids = checkpointed(named.join(_open_keys(named), "key", "left_semi").select("id", "name").distinct())
    of_ids = saved(narrowed(tokens, ids, "id").join(ids, "id"), "tokens", f"{folder}/tokens")
    # Mates with different names meet at open keys only, so an id needs no others.
    at = of_ids.select("id", "name", F.explode("keys").alias("key"))
    at = at.join(checkpointed(_open_keys(at).select("key")), "key", "left_semi")
    own = checkpointed(at.groupBy("id").agg(F.collect_list("key").alias("keys")))
    differing = saved(_differences(own, least, sets, members), "differences", f"{folder}/differences")
    rows = of_ids.drop("keys").join(own, "id").join(differing, "id").select("*", F.explode("keys").alias("key"))
    rows = saved(rows, "crossing", f"{folder}/crossing")
    columns = ("id", "name", "n", "rep", "difference", "keys", "others")
    left, right = (rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in columns]) for side in "ab")
    total = F.col("n_a") + F.col("n_b")
    sizes = F.size("difference_a") + F.size("difference_b")
    apart = sizes - 2 * F.size(F.array_intersect("difference_a", "difference_b"))
    same_rep = F.coalesce(
        (F.col("rep_a") == F.col("rep_b")) & F.col("difference_a").isNotNull() & F.col("difference_b").isNotNull(),
        F.lit(False),
    )
    # Of n_a + n_b members in all, ``apart`` lie in one set only.
    linked = (100 + percent) * apart <= (100 - percent) * total
    return (
        left.join(right, "key")
        .where(
            (F.col("id_a") < F.col("id_b"))
            & (F.col("name_a") != F.col("name_b"))
            & similar(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b"), percent)
            & (~same_rep | linked)
            & F.coalesce(F.arrays_overlap("others_a", "others_b"), F.lit(True))
            & (F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key"))
        )
        .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), same_rep.alias("linked"))
    )
