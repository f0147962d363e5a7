"""Chat formatting in budgeted windows, in DataFrame operations only.

Prefix sums of turn tokens choose the turn-aligned spans of a conversation. A window
is the system turn, a little history and a span; loss falls on the span's assistant
texts alone, so every target counts once however often it is repeated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.llm.shared import checkpointed

BUDGET = 2048
LONG_TURN = 512
HISTORY_TOKENS = 256
HISTORY_TURNS = 2
TURN_TOKENS = 4  # a turn's marks
BLOCK_TURNS = 256
TARGET = "assistant"
SYSTEM = "system"

# Fixed values of the template: a turn is <s>[role]text</s>, and inside a role or a text
# ~ is ~0, < is ~1, [ is ~2 and ] is ~3, so no mark can occur there.
BEGIN, ROLE_END, END = "<s>[", "]", "</s>"
ESCAPES = [("~", "~0"), ("<", "~1"), ("[", "~2"), ("]", "~3")]


def escaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


def turn_tokens(text: Column) -> Column:
    """Runs of ASCII letters, digits and _, and every other character that is not a space, plus the marks."""
    return F.regexp_count(text, F.lit(r"[0-9A-Za-z_]+|[^0-9A-Za-z_\x20\x09-\x0D]")) + TURN_TOKENS


def windows(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``(conv_id, block, span, text, n_repeated, loss)``: the formatted windows.

    ``conversations(conv_id, turn, role, text)`` has a row a turn; turns are ordered
    by number, equal ones by role and text, NULL numbers first; NULL roles and texts
    count as empty, a NULL conv_id is a conversation. ``loss`` holds the begin and
    length of each target in ``text``, in code points from 0; the first
    ``n_repeated`` turns of ``text`` repeat turns of earlier windows.

    Spans end where the prefix sum of tokens passes a multiple of what the budget
    leaves; a turn of more than ``LONG_TURN`` tokens is a span of its own, whole, and
    only such a one, or a long system turn, can exceed the budget. A conversation is
    taken in blocks of 256 turn numbers, each in windows of its own, so a very long
    one is spread over tasks. Other columns are ignored.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))))
    body = escaped(F.col("text"))
    head = F.concat(F.lit(BEGIN), escaped(F.col("role")), F.lit(ROLE_END))
    turns = turns.select(
        "conv_id", "block", "turn", "role", "text",
        turn_tokens(F.col("text")).alias("tokens"),
        F.concat(head, body, F.lit(END)).alias("piece"),
        F.length(head).alias("head"),
        F.length(body).alias("body"),
    )
    first = turns.groupBy("conv_id").agg(
        F.min(F.struct("block", "turn", "role", "text", "tokens", "piece")).alias("first")
    )
    system = checkpointed(
        first.where(F.col("first.role") == SYSTEM).select(
            F.col("conv_id").alias("system_of"),
            F.col("first.block").alias("first_block"),
            F.col("first.tokens").alias("system_tokens"),
            F.col("first.piece").alias("system"),
        )
    )
    with_system = turns.join(
        system.select("system_of", "system_tokens"), F.col("conv_id").eqNullSafe(F.col("system_of")), "left"
    ).drop("system_of")
    in_order = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    long = F.col("tokens") > LONG_TURN
    room = F.greatest(
        F.lit(1),
        F.lit(budget - LONG_TURN - HISTORY_TOKENS) - F.coalesce("system_tokens", F.lit(0)),
    )
    placed = with_system.select(
        "*",
        F.row_number().over(in_order).alias("place"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("so_far"),
        F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)).alias("chars_so_far"),
        (2 * F.count_if(long).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - long.cast("int")).alias("run"),
        room.alias("room"),
    )
    earlier = [F.lag(F.struct("place", "tokens", "piece"), k).over(in_order) for k in range(HISTORY_TURNS, 0, -1)]
    own = F.struct("place", "role", "chars_so_far", "head", "body", "piece", "earlier")
    bucket = F.when(long, F.lit(0)).otherwise(F.floor(F.col("so_far") / F.col("room")))
    spans = (
        placed.withColumn("earlier", F.array(*earlier))
        .groupBy("conv_id", "block", "run", bucket.alias("bucket"))
        .agg(F.array_sort(F.collect_list(own)).alias("own"))
        .select("conv_id", "block", "own", F.col("own")[0]["place"].alias("span"))
        .join(system.drop("system_tokens"), F.col("conv_id").eqNullSafe(F.col("system_of")), "left")
    )
    has_system = F.coalesce(F.col("block") == F.col("first_block"), F.lit(False))
    again = F.col("system").isNotNull() & ~(has_system & (F.col("span") == 1))
    history = F.expr(
        f"""filter(own[0].earlier, (p, i) -> p.place > first_place AND
            aggregate(slice(own[0].earlier, i + 1, {HISTORY_TURNS}), 0L,
                      (total, q) -> total + coalesce(q.tokens, 0)) <= {HISTORY_TOKENS})"""
    )
    formed = (
        spans.select("*", F.when(has_system, 1).otherwise(0).alias("first_place"))
        .select(
            "*",
            F.when(again, F.array("system")).otherwise(F.array().cast("array<string>")).alias("lead"),
            F.transform(history, lambda p: p["piece"]).alias("history"),
        )
        .select(
            "*",
            F.array_join(F.concat("lead", "history"), "").alias("repeated"),
            F.array_join(F.transform("own", lambda o: o["piece"]), "").alias("fresh"),
        )
    )
    loss = F.transform(
        F.filter("own", lambda o: o["role"] == TARGET),
        lambda o: F.struct(
            (F.length("repeated") + o["chars_so_far"] - F.col("own")[0]["chars_so_far"] + o["head"]).alias("begin"),
            o["body"].alias("length"),
        ),
    )
    return formed.select(
        "conv_id",
        "block",
        "span",
        F.concat("repeated", "fresh").alias("text"),
        (F.size("lead") + F.size("history")).alias("n_repeated"),
        loss.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from the windows alone."""

    def turn(piece: Column) -> Column:
        parts = F.split(piece, r"\]", 2)
        role = F.substring(parts[0], F.lit(len(BEGIN) + 1), F.length(parts[0]))
        return F.concat(unescaped(role), F.lit("\n"), unescaped(parts[1]), F.lit("\n"))

    pieces = F.split("text", END, -1)
    fresh = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    targets = F.transform("loss", lambda m: unescaped(F.substring(F.col("text"), m["begin"] + 1, m["length"])))
    of_window = formatted.select(
        "conv_id",
        F.struct(
            "block",
            "span",
            F.array_join(F.transform(fresh, turn), "").alias("turns"),
            F.array_join(targets, "").alias("targets"),
        ).alias("window"),
        F.size(fresh).alias("n"),
        F.length("text").alias("chars"),
    )

    def joined(field: str) -> Column:
        return F.array_join(F.transform("all", lambda w: w[field]), "")

    return (
        of_window.groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list("window")).alias("all"),
            F.sum("n").alias("n_turns"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2(joined("turns"), 256).alias("turns_sha256"),
            F.length(joined("targets")).cast("bigint").alias("loss_chars"),
            F.sha2(joined("targets"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
