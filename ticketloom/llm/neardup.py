"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of sketches (each sketch is a few minhashes) are computed
per document; a table key is a pair of one sketch from either collection. With
``SKETCHES`` = m that gives m * m tables of 2 * ``ROWS`` minhashes for the price of
2 * m sketches. Candidates are verified on whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.links import linked_components
from ticketloom.llm.shared import checkpointed, saved
from ticketloom.llm.wordhash import chunks, mixed

SKETCHES = 18
ROWS = 4
_FACTORS = (mixed(np.arange(2 * SKETCHES * ROWS, dtype=np.uint64), 7) | np.uint64(1)).view(np.int64)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z read as a-z.

    A text of fewer than ``width`` words has its whole word sequence as one shingle,
    a NULL or wordless one has none.
    """
    for low, high, words in chunks(column):
        hashes = words.hashes(lower=True)
        n = len(hashes)
        grams = np.full(max(n - width + 1, 0), np.uint64(width))
        for k in range(width):
            grams = mixed(grams ^ hashes[k : n - width + 1 + k], k)
        for row in range(high - low):
            first, last = words.first[row], words.first[row + 1]
            if last - first >= width:
                yield np.unique(grams[first : last - width + 1])
            elif last > first:
                whole = np.uint64(last - first)
                for k, h in enumerate(hashes[first:last]):
                    whole = mixed(np.asarray([whole ^ h]), k)[0]
                yield np.asarray([whole], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def _sketches(shingles: np.ndarray) -> np.ndarray:
    """Each minhash is the least product of a shingle and an odd factor of its own, modulo 2^64.

    The leading bits of a product depend on all of the shingle's, so minhashes of few
    shingles are as good as independent; distances to points by exclusive or are not.
    """
    if len(shingles) == 0:
        return np.zeros(2 * SKETCHES, np.int64)
    least = np.full(len(_FACTORS), np.iinfo(np.int64).max)
    whole = shingles.view(np.int64)
    for part in range(0, len(whole), 256):
        block = (whole[part : part + 256, None] * _FACTORS).min(axis=0)
        np.minimum(least, block, out=least)
    out = np.zeros(2 * SKETCHES, np.uint64)
    for row in range(ROWS):
        out = mixed(out ^ least.view(np.uint64)[row::ROWS], row)
    return out.view(np.int64)


def signatures(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """Per row: id, size and 128-bit print of the shingle set, and both sketch collections."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, left, right = [], [], [], []
            for shingles in shingle_sets(batch.column(1), width):
                n.append(len(shingles))
                totals = [mixed(shingles, seed).sum(dtype=np.uint64) for seed in (11, 12)]
                prints.append(np.asarray(totals, np.uint64).tobytes())
                sketch = _sketches(shingles)
                left.append(sketch[:SKETCHES])
                right.append(sketch[SKETCHES:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(left, pa.list_(pa.int64())),
                    pa.array(right, pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "set_print", "left", "right"],
            )

    return docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string")).mapInArrow(
        sign, "id bigint, n_shingles bigint, set_print binary, left array<bigint>, right array<bigint>"
    )


def shared_sketches(signed: DataFrame) -> DataFrame:
    """``(id, keys, others)``: the sketches of ``signed(id, left, right)`` that another id has.

    A table key can be shared only if both of its sketches are, so pairs are formed of
    these alone, which leaves a text without a partner with few or none.
    """
    sides = [
        signed.select("id", F.lit(side).alias("side"), F.posexplode(name).alias("place", "sketch"))
        for side, name in enumerate(("left", "right"))
    ]
    sketches = sides[0].unionAll(sides[1])
    key = ["side", "place", "sketch"]
    shared = checkpointed(
        sketches.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    )
    active = sketches.join(shared, key, "left_semi")
    value = F.xxhash64(*key)
    return saved(
        active.groupBy("id").agg(
            F.collect_list(F.when(F.col("side") == 0, value)).alias("keys"),
            F.collect_list(F.when(F.col("side") == 1, value)).alias("others"),
        ),
        "shared-sketches",
    )


def tensored_buckets(tokens: DataFrame) -> DataFrame:
    """``(key, id)`` of every table: a key is a pair of sketches, one of either collection."""
    pairs = tokens.select("id", F.explode("keys").alias("l"), "others")
    return pairs.select("id", "l", F.explode("others").alias("r")).select(
        F.xxhash64("l", "r").alias("key"), "id"
    )


def whole_sets(docs: DataFrame, ids: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """``(id, n, content)`` of the documents ``ids``; one for each text that an id has."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.view(np.int64) for x in shingle_sets(batch.column(1), width)]
            offsets = np.cumsum([0, *map(len, found)])
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                ],
                ["id", "n", "content"],
            )

    texts = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text")
    )
    return texts.join(ids, "id", "left_semi").mapInArrow(sets, "id bigint, n bigint, content array<bigint>")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row of ``docs``.

    Rows are linked if ``100 * intersection >= percent * union`` holds for their sets
    of ``width``-word shingles, A-Z read as a-z. A text with fewer words has its
    whole sequence as one shingle; a NULL or wordless text has none and is linked
    with nothing. ``component_id`` is the smallest id reachable by links, and the row
    with it is kept. Rows that repeat an id belong to one component; each is
    returned, with the flag of its id. A NULL id is never linked and always kept,
    with a NULL component. Other columns are ignored. A link at the threshold is
    found with probability 0.9998 by the tables alone (more above it).
    """
    signed = saved(signatures(docs, id_column, text_column, width), "signatures")
    full = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = saved(
        full.groupBy("set_print", "n_shingles").agg(F.min("id").alias("class_id")), "classes"
    )
    in_class = full.join(classes, ["set_print", "n_shingles"])
    members = saved(in_class.select("id", "class_id"), "members")
    first = in_class.where("id = class_id").select("id", "left", "right")
    tokens = shared_sketches(first)
    parts = linked_components(
        [tensored_buckets(tokens)],
        tokens,
        lambda ids: whole_sets(docs, ids, id_column, text_column, width),
        _of_repeated_ids(members),
        percent,
    )
    return _with_components(signed, _components_of_members(members, parts))


def _of_repeated_ids(members: DataFrame) -> DataFrame:
    """Links between the classes of an id that has several texts."""
    several = (
        members.groupBy("id")
        .agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
        .where("low <> high")
    )
    return members.join(several, "id", "left_semi").select(
        F.col("id").alias("a"), F.col("class_id").alias("b")
    )


def _components_of_members(members: DataFrame, parts: DataFrame) -> DataFrame:
    """The component of each id: that of its class, or the class itself if it is linked with none."""
    named = parts.select(F.col("node").alias("class_id"), "component")
    return (
        members.join(named, "class_id", "left")
        .groupBy("id")
        .agg(F.min(F.coalesce("component", "class_id")).alias("component_id"))
    )


def _with_components(signed: DataFrame, found: DataFrame) -> DataFrame:
    component = F.coalesce("component_id", "id")
    return (
        signed.select("id", "n_shingles")
        .join(found, "id", "left")
        .select(
            "id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        )
    )
