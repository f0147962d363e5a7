"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame operations only.

A window has as many words as the item it is held against. Windows that share too few
shingles with every item cannot be similar to one and are left out by an exact count.
The SimHashes of the others meet those of the items in a multi-index: with one block
of bits more than the radius, two fingerprints within the radius agree in a block.
What is within the radius is verified by exact weighted-shingle similarity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.shared import checkpointed, saved

WIDTH = 5
PERCENT = 80
BITS = 64
# At a similarity of 0.8 a bit differs with probability 0.15, so more than 20 of 64 do in 2 of 10,000.
RADIUS = 20
BROADCAST_SHINGLES = 1_000_000  # 8 bytes a shingle and as much for its item


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.col(text).cast("string")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def _shingle(width: int, position: str) -> Column:
    return F.xxhash64(*[F.get("words", F.col(position) + k) for k in range(width)])


def _positions(texts: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``keys``, ``at``, ``shingle``: the shingles of ``width`` words of ``words``, from 0."""
    last = F.size("words") - width
    return (
        texts.where(F.size("words") >= width)
        .select(*keys, "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select(*keys, "at", _shingle(width, "at").alias("shingle"))
    )


def benchmark_items(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(item_id, words, size, width)`` of items with a word; short ones are one shingle."""
    return (
        benchmark.select(F.col(id_column).cast("bigint").alias("item_id"), _words(text_column).alias("words"))
        .where("size(words) > 0")
        .select("*", F.size("words").alias("size"), F.least(F.size("words"), F.lit(WIDTH)).alias("width"))
    )


def simhash(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``print``: bit j is set if more shingles, with their weight, have it than not."""
    sums = [
        F.sum(F.when(F.col("shingle").bitwiseAND(1 << j if j < 63 else -(1 << 63)) != 0, 1).otherwise(-1)).alias(f"s{j}")
        for j in range(BITS)
    ]
    bits = [F.when(F.col(f"s{j}") > 0, F.lit(1 << j if j < 63 else -(1 << 63))).otherwise(F.lit(0)) for j in range(BITS)]
    value = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return shingles.groupBy(*keys).agg(*sums).select(*keys, value.cast("bigint").alias("print"))


def _blocks(radius: int) -> Column:
    """The blocks of a print: one more than the radius, as even as 64 bits allow."""
    edges = [BITS * b // (radius + 1) for b in range(radius + 2)]
    return F.array(
        *[
            F.shiftrightunsigned("print", low).bitwiseAND((1 << (high - low)) - 1)
            for low, high in zip(edges, edges[1:])
        ]
    )


def _indexed(prints: DataFrame, radius: int) -> DataFrame:
    return prints.select("*", F.posexplode(_blocks(radius)).alias("block", "bits"))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    radius: int = RADIUS,
    percent: int = PERCENT,
) -> DataFrame:
    """``(doc_id, text_print, item_id, start, size, shared, similarity)``: the most similar
    window, the first of equals, of each document and item that have a similar one.

    Similar: the weights (occurrences) of the 5-word shingles of the window and of the
    item overlap by 80 % or more of their union's. Words are lower-cased; an item of
    fewer words is one shingle. NULL or wordless texts and items match nothing.
    Repeated rows (same id, same text) are reported once, a NULL id as NULL. Other
    columns are ignored.
    """
    items = checkpointed(benchmark_items(benchmark, item_id_column, item_text_column))
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.xxhash64(F.col(text_column).cast("string")).alias("text_print"),
        F.col(text_column).alias("text"),
    )
    key = ["doc_id", "text_print"]
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())
    found = [_of_width(texts, items.where(F.col("width") == w), key, w, radius, percent) for w in widths]
    if not found:
        return texts.select(*key).limit(0).selectExpr(
            *key, "0L AS item_id", "0 AS start", "0 AS size", "0L AS shared", "0D AS similarity"
        )
    return reduce(DataFrame.unionAll, found)


def _of_width(
    texts: DataFrame, items: DataFrame, key: list[str], width: int, radius: int, percent: int
) -> DataFrame:
    of_items = checkpointed(_positions(items, ["item_id", "size"], width))
    weights = of_items.groupBy("item_id", "size", "shingle").agg(F.count(F.lit(1)).alias("weight"))
    known = checkpointed(weights.select("shingle", "item_id", "size"))
    least = F.col("size") - (width - 1)
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)

    # Documents with enough shingles of an item, counted exactly.
    enough = 100 * F.col("hits") >= percent * least
    near = (
        _positions(texts.select(*key, _words("text").alias("words")), key, width)
        .join(known, "shingle")
        .groupBy(*key, "item_id", "size")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(enough)
    )
    chosen = checkpointed(near.select(*key).distinct())
    own = texts.join(
        chosen.withColumnsRenamed({"doc_id": "d", "text_print": "t"}),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_print") == F.col("t")),
        "left_semi",
    )
    own = own.select(*key, _words("text").alias("words"))
    positions = saved(_positions(own, key, width).distinct(), "window-shingles")

    # Windows that share enough shingles with an item of their size.
    hits = positions.join(known, "shingle")
    starts = F.sequence(F.greatest(F.lit(0), F.col("at") - least + 1), F.col("at"))
    windows = (
        hits.select(*key, "item_id", "size", F.explode(starts).alias("start"))
        .groupBy(*key, "item_id", "size", "start")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(enough)
        .select(*key, "size", "start")
        .distinct()
    )
    ends = positions.groupBy(*key).agg(F.max("at").alias("last"))
    place = [*key, "size", "start"]

    def same_doc(other: str) -> Column:
        return F.col("doc_id").eqNullSafe(F.col(f"{other}_id")) & (F.col("text_print") == F.col(f"{other}_print"))

    ends = ends.withColumnsRenamed({"doc_id": "end_id", "text_print": "end_print"})
    whole = checkpointed(
        windows.join(ends, same_doc("end"))
        .where(F.col("start") + least - 1 <= F.col("last"))
        .select(*place)
    )
    at = positions.withColumnsRenamed({"doc_id": "at_id", "text_print": "at_print"})
    contents = saved(
        whole.select(*place, F.explode(F.sequence(F.col("start"), F.col("start") + least - 1)).alias("place"))
        .join(at, same_doc("at") & (F.col("place") == F.col("at")))
        .select(*place, "shingle"),
        "window-contents",
    )

    # The multi-index: prints within the radius agree in one of its blocks.
    prints = _indexed(simhash(contents, place), radius)
    item_prints = _indexed(simhash(of_items, ["item_id", "size"]), radius).select(
        "item_id", "size", "block", "bits", F.col("print").alias("item_print")
    )
    within = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    candidates = checkpointed(
        prints.join(item_prints, ["size", "block", "bits"]).where(within).select(*place, "item_id").distinct()
    )

    in_window = contents.groupBy(*place, "shingle").agg(F.count(F.lit(1)).alias("n"))
    in_window = in_window.withColumnsRenamed({c: f"w_{c}" for c in place})
    same = F.col("doc_id").eqNullSafe(F.col("w_doc_id")) & reduce(
        Column.__and__, [F.col(c) == F.col(f"w_{c}") for c in place[1:]]
    )
    shared = (
        candidates.join(in_window, same)
        .join(weights.select("item_id", "shingle", "weight"), ["item_id", "shingle"])
        .groupBy(*place, "item_id")
        .agg(F.sum(F.least("n", "weight")).alias("shared"))
        .where(100 * F.col("shared") >= percent * (2 * least - F.col("shared")))
    )
    best = F.max_by(F.struct("start", "shared"), F.col("shared") * (1 << 32) - F.col("start"))
    return (
        shared.groupBy(*key, "item_id", "size")
        .agg(best.alias("best"))
        .select(
            *key,
            "item_id",
            "best.start",
            "size",
            "best.shared",
            (F.col("best.shared") / (2 * least - F.col("best.shared"))).alias("similarity"),
        )
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that have no window similar to an item, with all their columns."""
    found = checkpointed(
        contaminated(docs, benchmark, id_column, text_column)
        .select(F.col("doc_id").alias("found_id_"), F.col("text_print").alias("found_print_"))
        .distinct()
    )
    same = docs[id_column].cast("bigint").eqNullSafe(found["found_id_"]) & (
        F.xxhash64(docs[text_column].cast("string")) == found["found_print_"]
    )
    return docs.join(found, same, "left_anti")
