"""Substitution by a phrase table of any size: the longest phrase at the leftmost place, then the next.

The table is a token trie in rows, one per prefix of a phrase. A Bloom filter of its
prefixes, of bounded size, lets a text's places go that begin no phrase; what is left is
joined with the trie's rows, once per text and phrase. The table itself is not in the plan
or sent to all tasks, unless Spark finds it small enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.session import discarded, shared_path, staged

# A word is a run of letters; the words of a phrase have white space between them.
WORD = r"\p{L}+"
SPACE = r"^\s+$"
# Bits a prefix, bits at most (32 MB) and bits set for each. A full filter lets more places
# through; what they are is settled by the join.
BITS_PER_PREFIX, MOST_BITS, PROBES = 16, 1 << 28, 3
_BLOCK_WORDS = 1 << 19
# Texts of more characters in all are substituted in so many turns.
CHARACTERS, TURNS = 1 << 26, 8


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def between_words(text: Column) -> Column:
    """What precedes the first word, lies between two, and follows the last: one more than words."""
    return F.split(text, WORD)


def phrase_trie(phrases: DataFrame, phrase: str = "phrase", answer: str = "answer") -> DataFrame:
    """``(prefix, depth, answer, longer)``: every prefix of a phrase, its answer if it is one, and
    whether a phrase goes on from it.

    Words are lower-cased; phrases without a word or an answer are left out. Of several
    answers of a phrase the smallest counts.
    """
    listed = phrases.where(F.col(answer).isNotNull()).select(
        words_of(F.lower(phrase)).alias("words"), F.col(answer).cast("string").alias("answer")
    )
    size = F.size("words")
    prefixes = listed.where(size > 0).select(
        "words", "answer", size.alias("size"), F.explode(F.sequence(F.lit(1), size)).alias("depth")
    )
    return prefixes.groupBy(F.array_join(F.slice("words", 1, F.col("depth")), " ").alias("prefix"), "depth").agg(
        F.min(F.when(F.col("depth") == F.col("size"), F.col("answer"))).alias("answer"),
        F.max(F.col("depth") < F.col("size")).alias("longer"),
    )


def _longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The hashes of prefixes that are one word longer."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15) + words
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _probe(hashes: np.ndarray, k: int, bits: int) -> np.ndarray:
    return (hashes + np.uint64(k) * ((hashes >> np.uint64(31)) | np.uint64(1))) & np.uint64(bits - 1)


def _uint64(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _prefix_filter(trie: DataFrame) -> np.ndarray:
    """A Bloom filter of the trie's prefixes as 64-bit words."""
    bits = 1 << 10
    wanted = trie.count() * BITS_PER_PREFIX
    while bits < min(wanted, MOST_BITS):
        bits *= 2

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            first = lists.offsets.to_numpy().astype(np.int64)
            words, sizes = _uint64(lists.values), np.diff(first)
            hashes, alive, level = np.zeros(len(sizes), np.uint64), np.arange(len(sizes)), 0
            while len(alive := alive[sizes[alive] > level]):
                hashes[alive] = _longer(hashes[alive], words[first[alive] + level])
                level += 1
            at = np.concatenate([_probe(hashes, k, bits) for k in range(PROBES)])
            slots, inverse = np.unique(at >> np.uint64(6), return_inverse=True)
            masks = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(masks, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(masks.view(np.int64))], ["slot", "mask"])

    hashed = trie.select(F.transform(F.split("prefix", " "), lambda w: F.xxhash64(w)).alias("words"))
    found = hashed.mapInArrow(set_bits, "slot int, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[found["slot"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def _maybe(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold, as indices."""
    left = np.arange(len(hashes))
    for k in range(PROBES):
        at = _probe(hashes[left], k, len(filled) << 6)
        left = left[(filled[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
    return left


def _candidates(block: pa.RecordBatch, filled: np.ndarray, depth: int) -> Iterator[pa.RecordBatch]:
    """The places of a few texts where a phrase may begin, depth by depth, those of a text and phrase together."""
    keys, texts = block.column(0), block.column(1)
    first = texts.offsets.to_numpy().astype(np.int64)
    base, first = first[0], first - first[0]
    values = texts.values.slice(base, first[-1])
    words, hashes = values.field("w"), _uint64(values.field("h"))
    # A word that white space does not join to the one before it ends every phrase there.
    joined = values.field("joined").to_numpy(zero_copy_only=False).astype(bool)
    joined[first[:-1][first[:-1] < len(joined)]] = False
    at, prefix = np.arange(len(words)), _longer(np.zeros(len(words), np.uint64), hashes)
    for level in range(1, depth + 1):
        kept = _maybe(filled, prefix)
        at, prefix = at[kept], prefix[kept]
        if not len(at):
            return
        phrase = words.take(pa.array(at))
        for k in range(1, level):
            phrase = pc.binary_join_element_wise(phrase, words.take(pa.array(at + k)), " ")
        row = np.searchsorted(first, at, side="right") - 1
        code = phrase.dictionary_encode().indices.to_numpy()
        order = np.lexsort((code, row))
        starts = np.flatnonzero(np.append(True, (np.diff(row[order]) != 0) | (np.diff(code[order]) != 0)))
        head = order[starts]
        ends = pa.array(np.append(starts, len(order)).astype(np.int32))
        places = pa.ListArray.from_arrays(ends, pa.array((at - first[row])[order].astype(np.int32)))
        columns = [keys.take(pa.array(row[head])), places, pa.array(np.full(len(head), level, np.int32)), phrase.take(pa.array(head))]
        yield pa.RecordBatch.from_arrays(columns, ["key", "places", "n_words", "phrase"])
        following = at + level
        goes_on = following < len(words)
        goes_on[goes_on] = joined[following[goes_on]]
        at, prefix = at[goes_on], _longer(prefix[goes_on], hashes[following[goes_on]])


def phrase_places(
    texts: DataFrame, trie: DataFrame, key: str, text: str, depth: int, filled: np.ndarray | None = None
) -> DataFrame:
    """``(key, places, n_words, answer)``: every phrase of every text, and the words it begins at.

    ``depth`` is the number of words of the longest phrase, ``filled`` the filter of the trie's
    prefixes, if there is one already; the trie is read more than once.
    A phrase that most texts have is a hot key of the join, whose two sides come straight
    from shuffles: adaptive execution may split it.
    """
    filled = _prefix_filter(trie) if filled is None else filled

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, low = batch.column(1).offsets.to_numpy(), 0
            while low < batch.num_rows:  # some texts at a time, or one
                high = max(low + 1, int(np.searchsorted(ends, ends[low] + _BLOCK_WORDS, side="right")) - 1)
                yield from _candidates(batch.slice(low, high - low), filled, depth)
                low = high

    lower = F.lower(text)
    # Arrays are zipped, never indexed within a lambda: that would build them anew for every word.
    zipped = F.arrays_zip(words_of(lower).alias("w"), between_words(lower).alias("gap"))
    word = F.transform(
        F.filter("zipped", lambda z: z["w"].isNotNull()),
        lambda z: F.struct(z["w"].alias("w"), F.xxhash64(z["w"]).alias("h"), z["gap"].rlike(SPACE).alias("joined")),
    )
    split = texts.where(F.col(text).isNotNull()).select(F.col(key), zipped.alias("zipped")).select(key, word.alias("words"))
    of = split.schema[key].dataType.simpleString()
    found = split.mapInArrow(search, f"`{key}` {of}, places array<int>, n_words int, phrase string")
    answers = trie.where("answer IS NOT NULL").select("prefix", "answer")
    return found.join(answers, F.col("phrase") == F.col("prefix")).select(key, "places", "n_words", "answer")


def phrase_matches(texts: DataFrame, trie: DataFrame, key: str, text: str, depth: int) -> DataFrame:
    """``(key, pos, n_words, answer)``: every phrase at every word of every text."""
    found = phrase_places(texts, trie, key, text, depth)
    return found.select(key, F.explode("places").alias("pos"), "n_words", "answer")


def substituted(words: list[str], gaps: list[str], places: list[tuple[int, int, str]]) -> str:
    """The text with the answers of the places (position, words, answer) that leftmost-longest takes."""
    out, at = [gaps[0]], 0
    for pos, n, answer in sorted(places, key=lambda p: (p[0], -p[1])):
        if pos >= at:
            for k in range(at, pos):
                out += (words[k], gaps[k + 1])
            at = pos + n
            out += (answer, gaps[at])
    for k in range(at, len(words)):
        out += (words[k], gaps[k + 1])
    return "".join(out)


def _assembled(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for batch in parts:
        yield pd.Series(
            [
                None
                if words is None
                else substituted(
                    list(words),
                    list(gaps),
                    [(at, n, answer) for own, n, answer in zip(places, sizes, answers, strict=True) for at in own],
                )
                for words, gaps, places, sizes, answers in zip(*batch, strict=True)
            ],
            dtype=object,
        )


def substitute_phrases(df: DataFrame, column: str, phrases: DataFrame, output: str) -> DataFrame:
    """``df`` with ``output``: the text of ``column`` with every phrase of the table replaced.

    ``phrases`` has the columns phrase and answer. From the first word on, the longest phrase
    that begins at a word is replaced and the search goes on behind it. Case does not
    matter; between the words of a phrase a text may have any white space, but no other
    character. All else of the text stays as it is; NULL stays NULL.
    """
    trie = staged(phrase_trie(phrases), "phrase-trie")
    depth = trie.agg(F.max("depth").alias("d")).first()["d"]
    if depth is None:
        return df.withColumn(output, F.col(column))
    filled = _prefix_filter(trie)
    rows = df.withColumn("__row", F.monotonically_increasing_id())
    if (df.agg(F.sum(F.length(column))).first()[0] or 0) <= CHARACTERS:
        return _substituted(staged(rows, "texts"), column, trie, depth, filled, output)
    # Every word may be a phrase, so what is shuffled for a text is several times as large as it.
    spark, path = df.sparkSession, shared_path(df.sparkSession, "texts")
    turn = F.pmod(F.xxhash64("__row"), F.lit(TURNS)).alias("__turn")
    rows.select("*", turn).write.option("compression", "zstd").partitionBy("__turn").parquet(path)
    found = []
    for k in range(TURNS):
        part = spark.read.schema(rows.schema).parquet(f"{path}/__turn={k}")
        found.append(staged(_substituted(part, column, trie, depth, filled, output), "substituted"))
        discarded(spark, f"{path}/__turn={k}")
    return reduce(DataFrame.unionAll, found)


def _substituted(rows: DataFrame, column: str, trie: DataFrame, depth: int, filled: np.ndarray, output: str) -> DataFrame:
    matches = phrase_places(rows, trie, "__row", column, depth, filled)
    lists = matches.groupBy(F.col("__row").alias("__of")).agg(F.collect_list(F.struct("places", "n_words", "answer")).alias("__places"))
    text = F.when(F.col("__places").isNotNull(), F.col(column))
    fields = [F.col(f"__places.{name}") for name in ("places", "n_words", "answer")]
    joined = rows.join(lists, F.col("__row") == F.col("__of"), "left")
    replaced = F.pandas_udf(_assembled, "string")(words_of(text), between_words(text), *fields)
    return joined.withColumn(output, F.coalesce(replaced, F.col(column))).drop("__row", "__of", "__places")
