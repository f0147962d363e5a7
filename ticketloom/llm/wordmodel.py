"""Perplexity of whole texts under a word model: modified Kneser-Ney of order 3, each text left out.

A text is its words after two marks of the beginning and before one of the end. Texts
are tokenised once, into blocks of one language with a dictionary of their own, whose
words are numbered over all blocks by their hashes, common words first. The trigrams of a block go, slice by slice, to the shards of their middle words as
sorted arrays; a shard has all that is counted there about a trigram, its context, its
bigram and that one's context, and answers each block with arrays in the order asked.
A middle word of more trigrams than a quarter shard has is dealt by both pairs of its
trigrams instead. A text is scored by what is left of every count without its own
occurrences, so it is not made likely by having been counted itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.shared import checkpointed, saved, scratch
from ticketloom.session import discarded, shared_path
from ticketloom.llm.wordhash import chunks, distinct, mixed

BEGIN, END = 0, 1
TEXT = ["h1", "h2", "lang"]
BLOCK = 1 << 20  # words of a block, or one text
SHARD = 1 << 19  # words of a shard
SLICES = 8
SCORED = 1 << 17  # words scored at once, or one text
_KINDS = ("once", "twice", "more")
_WHOLE, _PREFIX, _SUFFIX, _WORDS = 0, 1, 2, 3  # what a shard has of its trigrams
_ORDER3, _ORDER2 = (["n", "total3", *[f"{k}3" for k in _KINDS]], ["m", "total2", *[f"{k}2" for k in _KINDS]])
_COLUMNS = {_WHOLE: _ORDER3 + _ORDER2, _PREFIX: _ORDER3, _SUFFIX: ["m"], _WORDS: ["u"]}
_OF_WORDS, _OF_HOT, _OF_DISCOUNTS, _OF_LANGUAGE = -1, -2, -3, -4  # no blocks: sums of a shard
_ONE = ["total1", "words", *[f"{k}1" for k in _KINDS], *[f"n{k}" for k in (1, 2, 3, 4)]]
_BLOCK = "block bigint, lang string, n bigint, h1 binary, h2 binary, lengths binary, words binary, tokens binary"
_REPLY = "block bigint, lang string, role int, slice int, shard bigint, words binary, data binary"


def text_prints(text_column: str) -> list[Column]:
    """Two hashes that stand for a text; equal texts have equal scores."""
    text = F.col(text_column).cast("string")
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, compressed byte by byte of their width."""
    width = np.uint32 if len(values) == 0 or values.max() < 1 << 32 else np.uint64
    values = np.ascontiguousarray(values, width)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    head = np.array([len(values), values.itemsize], np.int64).tobytes()
    return head + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n, width = (int(x) for x in np.frombuffer(data, np.int64, 2))
    planes = pa.decompress(data[16:], n * width, codec="zstd", asbytes=True) if n else b""
    values = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T)
    return values.reshape(-1).view(f"u{width}").astype(np.int64)


def _ascending(numbers: np.ndarray) -> bytes:
    return _packed(np.diff(numbers, prepend=0))


def _from_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def _cut_blocks(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """Two rows per block of texts of a language: their prints and lengths and the place of each
    word in the block's list; and that list, the hashes of its words: both marks, then by frequency."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32

        def block(lang: str) -> pa.RecordBatch:
            nonlocal number
            parts = [np.concatenate(x) for x in zip(*held.pop(lang), strict=True)]
            del size[lang]
            one, at, times = distinct(parts[3])
            order = np.argsort(-times, kind="stable")
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            listed = np.concatenate([np.array([BEGIN, END], np.uint64), parts[3][one][order]])
            rows = [
                {
                    "kind": 0, "block": number, "lang": lang, "n": len(at), "h1": parts[0].tobytes(),
                    "h2": parts[1].tobytes(), "lengths": _packed(parts[2]), "words": None, "tokens": _packed(place[at] + 2),
                },
                {"kind": 1, "block": number, "lang": lang, "n": len(listed), "words": listed.tobytes()},
            ]
            number += 1
            return pa.RecordBatch.from_pylist(rows)

        for batch in batches:
            coded = batch.column(2).dictionary_encode()
            codes, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            prints = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            for low, high, words in chunks(batch.column(3)):
                lengths, hashes, rows = np.diff(words.first), words.hashes(), words.rows()
                for code in np.unique(codes[low:high]):
                    own = (codes[low:high] == code) & (lengths > 0)
                    if not own.any():
                        continue
                    lang = names[code]
                    held.setdefault(lang, []).append(
                        (prints[0][low:high][own], prints[1][low:high][own], lengths[own], hashes[own[rows]])
                    )
                    size[lang] = size.get(lang, 0) + int(lengths[own].sum())
                    if size[lang] >= BLOCK:
                        yield block(lang)
        for lang in list(held):
            yield block(lang)

    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("")).alias("lang")
    texts = docs.select(*text_prints(text_column), lang, F.col(text_column).cast("string").alias("text"))
    return texts.mapInArrow(cut, f"kind bigint, {_BLOCK}")


def _dealt_words(numbers: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of a list of words in each of their shards; the marks are in the first one."""
    shard = np.where(numbers < 2, 0, (numbers.view(np.uint64) - np.uint64(2)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    bounds = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(shard[order[low]]), order[low:high]


def _reply(row: dict, **values) -> dict:
    return {"block": row["block"], "lang": row["lang"], "role": _WORDS, "slice": 0, "shard": 0, "words": None, "data": None} | values


def _numbers(lists: DataFrame, shards: dict[str, int]) -> DataFrame:
    """For each block the places and numbers of its words, shard by shard of their hashes."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], np.uint64)
                homes = np.where(words < 2, words, (mixed(words, 31) >> np.uint64(1)) + np.uint64(2)).view(np.int64)
                asked = [
                    _reply(row, shard=shard, words=words[index].tobytes(), data=_ascending(index))
                    for shard, index in _dealt_words(homes, shards[row["lang"]])
                ]
                yield pa.RecordBatch.from_pylist(asked, schema=schema)

    def number(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sent = [np.frombuffer(row["words"], np.uint64) for row in rows]
        words = np.concatenate(sent)
        one, at, times = distinct(words)
        order = np.argsort(-times, kind="stable")
        numbers = np.empty(len(order), np.int64)
        numbers[order] = np.arange(len(order)) * shards[rows[0]["lang"]] + rows[0]["shard"] + 2
        marks = words[one] < 2
        numbers[marks] = words[one][marks].view(np.int64)
        parts = np.split(numbers[at], np.cumsum([len(x) for x in sent])[:-1])
        return pa.Table.from_pylist([row | {"words": _packed(x)} for row, x in zip(rows, parts, strict=True)], schema=schema)

    schema = _reply_schema()
    asked = lists.select("block", "lang", "words").mapInArrow(ask, _REPLY)
    return asked.groupBy("lang", "shard").applyInArrow(number, _REPLY)


def token_blocks(docs: DataFrame, text_column: str, lang_column: str, folder: str | None = None) -> DataFrame:
    """One row per block of texts of a language: their prints and lengths, the numbers of the
    block's distinct words, both marks first and then by frequency, and the place of each word
    in that list. Lists of hashes are removed when they are numbered, as they are half as large.
    The blocks are written to ``folder``, if there is one."""

    def named(left: pa.Table, right: pa.Table) -> pa.Table:
        row, answers = left.to_pylist()[0], right.to_pylist()
        index = np.concatenate([_from_ascending(r["data"]) for r in answers])
        words = np.empty(len(index), np.int64)
        words[index] = np.concatenate([_unpacked(r["words"]) for r in answers])
        return pa.Table.from_pylist([row | {"words": _packed(words)}], schema=left.schema)

    spark = docs.sparkSession
    path = shared_path(spark, "word-lists")
    _cut_blocks(docs, text_column, lang_column).write.partitionBy("kind").parquet(path)
    cut = spark.read.schema(f"{_BLOCK}, kind bigint").parquet(path)
    lists, tokens = cut.where("kind = 1"), cut.where("kind = 0").drop("kind")
    sizes = lists.groupBy("lang").agg(F.sum("n").alias("n")).collect()
    given = shared_path(spark, "word-numbers")
    numbers = saved(_numbers(lists, _shards(sizes)), "word-numbers", given)
    discarded(spark, f"{path}/kind=1")
    blocks = []
    for k in range(SLICES):
        mine = F.pmod(F.xxhash64("block"), F.lit(SLICES)) == k
        of_block = [x.where(mine).groupBy("block") for x in (tokens, numbers)]
        blocks.append(saved(of_block[0].cogroup(of_block[1]).applyInArrow(named, _BLOCK), "word-blocks", folder and f"{folder}/word-blocks-{k}"))
    for gone in (path, given):
        discarded(spark, gone)
    return reduce(DataFrame.unionAll, blocks)


def _shards(sizes: list) -> dict[str, int]:
    """How many shards the ``n`` rows of each language are dealt to."""
    return {r["lang"]: -(-r["n"] // SHARD) for r in sizes}


@dataclass
class Trigrams:
    """Trigrams of a block as numbers in ``words``, and the text of each."""

    words: np.ndarray
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    row: np.ndarray

    def of(self, index: np.ndarray) -> Trigrams:
        return Trigrams(self.words, self.a[index], self.b[index], self.c[index], self.row[index])

    def keys(self) -> np.ndarray:
        """Equal for equal trigrams; ordered by the middle word in all but immense blocks."""
        if len(self.words) < 1 << 21:
            return self.b << 42 | self.a << 21 | self.c
        return _mixed_key(self.a, self.b, self.c).view(np.int64)


def _trigrams(words: bytes, lengths: bytes, tokens: bytes) -> Trigrams:
    n_words = _unpacked(lengths)
    row = np.repeat(np.arange(len(n_words)), n_words + 3)
    ends = np.cumsum(n_words + 3) - 1
    begins = ends - n_words - 2
    line = np.zeros(len(row), np.int64)
    inner = np.ones(len(row), bool)
    inner[begins] = inner[begins + 1] = inner[ends] = False
    line[inner] = _unpacked(tokens)
    line[ends] = 1
    inner[ends] = True
    at = np.flatnonzero(inner)
    return Trigrams(_unpacked(words), line[at - 2], line[at - 1], line[at], row[at])


def _homes(words: np.ndarray) -> np.ndarray:
    return mixed(words.view(np.uint64), 21)


def _routes(x: Trigrams, hot: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each role: which of the trigrams go to its shards, and the hash that says where."""
    home = _homes(x.words)
    dealt = np.isin(x.words, hot)[x.b]
    usual, spread = np.flatnonzero(~dealt), np.flatnonzero(dealt)
    yield _WHOLE, usual, home[x.b[usual]]
    yield _PREFIX, spread, mixed(home[x.b[spread]] ^ mixed(x.words[x.a[spread]].view(np.uint64), 22), 23)
    yield _SUFFIX, spread, mixed(home[x.b[spread]] ^ mixed(x.words[x.c[spread]].view(np.uint64), 24), 25)


def _dealt(x: Trigrams, hot: np.ndarray, shards: int, slices: range) -> Iterator[tuple]:
    """``(role, slice, shard, index)`` of all that a block asks or is answered, in one order."""
    for role, index, key in _routes(x, hot):
        part = (key % np.uint64(SLICES)).astype(np.int64)
        shard = (key // np.uint64(SLICES) % np.uint64(shards)).astype(np.int64)
        for k in slices:
            own = np.flatnonzero(part == k)
            own = own[np.argsort(shard[own], kind="stable")]
            bounds = np.flatnonzero(np.diff(shard[own], prepend=-1, append=-1))
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                yield role, k, int(shard[own[low]]), index[own[low:high]]


def _mixed_key(*values: np.ndarray) -> np.ndarray:
    key = np.zeros(len(values[0]), np.uint64)
    for v in values:
        key = mixed(key ^ v.view(np.uint64), 5)
    return key


def _numbered(*values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return distinct(_mixed_key(*values))[:2]


def _asked(blocks: DataFrame, hot: dict, shards: dict[str, int], k: int) -> DataFrame:
    """The distinct trigrams of each block in slice ``k``, for each shard."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, of_lang = _trigrams(row["words"], row["lengths"], row["tokens"]), hot.get(row["lang"], np.zeros(0, np.int64))
                here = (_homes(x.words) % np.uint64(SLICES) == np.uint64(k)) | np.isin(x.words, of_lang)
                x = x.of(np.flatnonzero(here[x.b]))
                first, _, times = distinct(x.keys())
                x = x.of(first)
                for role, part, shard, index in _dealt(x, of_lang, shards[row["lang"]], range(k, k + 1)):
                    numbers = x.words[np.concatenate([v[index] for v in (x.a, x.b, x.c)])]
                    one, at, _ = distinct(numbers)
                    data = _packed(np.concatenate([at, times[index]]))
                    sent = _reply(row, role=role, slice=part, shard=shard, words=_ascending(numbers[one]), data=data)
                    yield pa.RecordBatch.from_pylist([sent], schema=batch_schema)

    batch_schema = _reply_schema()
    return blocks.mapInArrow(ask, _REPLY)


def _reply_schema() -> pa.Schema:
    return pa.schema(
        [("block", pa.int64()), ("lang", pa.string()), ("role", pa.int32()), ("slice", pa.int32()), ("shard", pa.int64()),
         ("words", pa.binary()), ("data", pa.binary())]
    )


def _of_contexts(n: np.ndarray, context: np.ndarray) -> list[np.ndarray]:
    """The total of each n-gram's context and how many of its n-grams occur once, twice and more."""
    kinds = [np.bincount(context, x) for x in (n, n == 1, n == 2, n > 2)]
    return [k[context].astype(np.int64) for k in kinds]


def _answer(table: pa.Table, word_shards: int) -> pa.Table:
    """What a shard counts, for each block in the order it asked, and the shard's own sums.

    Counts are sent without the block's own, and totals without what follows from the
    kinds, so most of these are 0.
    """
    rows = table.to_pylist()
    role = rows[0]["role"]
    sent = []
    for row in rows:
        a, b, c, times = _unpacked(row["data"]).reshape(4, -1)
        words = _from_ascending(row["words"])
        sent.append((words[a], words[b], words[c], times))
    sizes = np.cumsum([0, *(len(x[3]) for x in sent)])
    a, b, c, times = (np.concatenate(x) for x in zip(*sent, strict=True))
    first, at = _numbered(a, b, c)
    n = np.bincount(at, times).astype(np.int64)
    a, b, c = a[first], b[first], c[first]
    columns, sums, seen = [], [], np.zeros(8, np.int64)
    if role != _SUFFIX:
        columns += [n, *_of_contexts(n, _numbered(a, b)[1])]
        seen[:4] = [(n == k).sum() for k in (1, 2, 3, 4)]
    if role != _PREFIX:
        pair, of_pair = _numbered(b, c)
        b, c = b[pair], c[pair]
        m = np.where(b == BEGIN, np.bincount(of_pair, n), np.bincount(of_pair)).astype(np.int64)
        seen[4:] = [(m == k).sum() for k in (1, 2, 3, 4)]
        word, _, before = distinct(c)
        word = c[word]
        sums += [(_OF_WORDS, word[own], before[own], shard) for shard, own in _dealt_words(word, word_shards)]
        head, of_head = _numbered(b)
        contexts = _of_contexts(m, of_head)
        columns += [x[of_pair] for x in ([m] if role == _SUFFIX else [m, *contexts])]
        if role == _SUFFIX:
            sums.append((_OF_HOT, b[head], np.concatenate([x[head] for x in contexts]), 0))
    sums.append((_OF_DISCOUNTS, np.zeros(0, np.int64), seen, 0))
    if role != _SUFFIX:
        columns[1] = columns[1] - columns[2] - 2 * columns[3] - 3 * columns[4]
    if role == _WHOLE:
        columns[6] = columns[6] - columns[7] - 2 * columns[8] - 3 * columns[9]
    answers = np.stack(columns)[:, at]
    if role != _SUFFIX:
        answers[0] -= times
    out = [
        row | {"words": None, "data": _packed(answers[:, low:high].reshape(-1))}
        for row, low, high in zip(rows, sizes[:-1], sizes[1:], strict=True)
    ]
    out += [_reply(rows[0], block=kind, shard=k, words=_packed(w), data=_packed(x)) for kind, w, x, k in sums]
    return pa.Table.from_pylist(out, schema=_reply_schema())


def _frequent(blocks: DataFrame, n_blocks: int) -> dict[str, np.ndarray]:
    """The words of each language that may occur in more than a quarter shard's trigrams.

    A block leaves out words too rare to matter, which are at most half of that in all.
    """
    limit = SHARD // 8

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                times = np.bincount(_unpacked(row["tokens"]), minlength=1)
                times[BEGIN] = len(_unpacked(row["lengths"]))
                often = np.flatnonzero(times * n_blocks >= limit)
                lang = pa.array([row["lang"]] * len(often), pa.string())
                words = pa.array(_unpacked(row["words"])[often])
                yield pa.RecordBatch.from_arrays([lang, words, pa.array(times[often])], ["lang", "b", "n"])

    found = blocks.mapInArrow(count, "lang string, b bigint, n bigint").groupBy("lang", "b").agg(F.sum("n").alias("n"))
    hot: dict[str, list] = {}
    for row in found.where(F.col("n") > limit).collect():
        hot.setdefault(row["lang"], []).append(row["b"])
    return {lang: np.sort(np.array(words, np.int64)) for lang, words in hot.items()}


def _continuations(blocks: DataFrame, sums: DataFrame, shards: dict[str, int]) -> DataFrame:
    """For each block how many words stand before each of its words, as answers, and the sums of
    these counts over all words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = _unpacked(row["words"])
                asked = [_reply(row, shard=k, words=_packed(words[own])) for k, own in _dealt_words(words, shards[row["lang"]])]
                yield pa.RecordBatch.from_pylist(asked, schema=schema)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [(_unpacked(r["words"]), _unpacked(r["data"])) for r in right.to_pylist()]
        if not parts:
            parts = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
        words = np.concatenate([w for w, _ in parts])
        one, at, _ = distinct(words)
        words = words[one]
        u = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
        rows, out = left.to_pylist(), []
        for row in rows:
            wanted = _unpacked(row["words"])
            place = np.minimum(np.searchsorted(words, wanted), len(words) - 1)
            out.append(row | {"words": None, "data": _packed(np.where(words[place] == wanted, u[place], 0))})
        u = u[u > 0]
        kinds = [len(u), (u == 1).sum(), (u == 2).sum(), (u > 2).sum(), *[(u == k).sum() for k in (1, 2, 3, 4)]]
        out.append(_reply(rows[0], block=_OF_LANGUAGE, data=_packed(np.array([u.sum(), *kinds]))))
        return pa.Table.from_pylist(out, schema=schema)

    schema = _reply_schema()
    asked = blocks.select("block", "lang", "words").mapInArrow(ask, _REPLY).groupBy("lang", "shard")
    return asked.cogroup(sums.where(F.col("block") == _OF_WORDS).groupBy("lang", "shard")).applyInArrow(count, _REPLY)


def _discounts(times: list[int]) -> np.ndarray:
    """The discounts of n-grams that occur never, once, twice and more often, from how many occur
    one to four times."""
    ratio = times[0] / (times[0] + 2 * times[1]) if times[0] + times[1] else None
    return np.array(
        [0.0]
        + [
            max(0.1, min(k, k - (k + 1) * ratio * times[k] / times[k - 1]))
            if ratio is not None and times[k - 1]
            else 0.5 * k
            for k in (1, 2, 3)
        ]
    )


def _added(sums: DataFrame, kind: int, names: list[str]) -> list:
    """``(lang, word, names)``: the shards' sums of a kind added up, for each of the words they have."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = _unpacked(row["data"]).reshape(len(names), -1)
                words = _unpacked(row["words"]) if kind == _OF_HOT else np.zeros(1, np.int64)
                lang = pa.array([row["lang"]] * len(words), pa.string())
                yield pa.RecordBatch.from_arrays([lang, pa.array(words), *map(pa.array, values)], ["lang", "word", *names])

    schema = "lang string, word bigint, " + ", ".join(f"{n} bigint" for n in names)
    flat = sums.where(F.col("block") == kind).select("lang", "words", "data").mapInArrow(rows, schema)
    return flat.groupBy("lang", "word").agg(*[F.sum(n).alias(n) for n in names]).collect()


def _languages(answers: DataFrame, counted: DataFrame) -> dict[str, dict]:
    """Totals and discounts of each language, and the contexts of its frequent words."""
    seen = {r["lang"]: list(r)[2:] for r in _added(answers, _OF_DISCOUNTS, [f"n{k}" for k in range(8)])}
    found = {}
    for row in _added(counted, _OF_LANGUAGE, _ONE):
        times = seen[row["lang"]]
        discounts = [_discounts(x) for x in ([row[f"n{k}"] for k in (1, 2, 3, 4)], times[4:], times[:4])]
        found[row["lang"]] = row.asDict() | {"discounts": discounts, "heads": {}}
    for row in _added(answers, _OF_HOT, _ORDER2[1:]):
        found[row["lang"]]["heads"][row["word"]] = [row[k] for k in _ORDER2[1:]]
    return found


def _order(count, less, context, total, kinds, discounts, below):
    """Probabilities of one order, where ``less`` is left of ``count`` without the text's own."""
    total = total - np.bincount(context, count - less)[context]
    weight = np.zeros(len(count))
    for k, kind in enumerate(kinds, 1):
        change = (np.minimum(less, 3) == k).astype(int) - (np.minimum(count, 3) == k)
        weight += discounts[k] * (kind + np.bincount(context, change)[context])
    share = less - discounts[np.minimum(less, 3)] + weight * below
    return np.where(total > 0, share / np.maximum(total, 1), below)


def left_out(x: dict[str, np.ndarray], language: dict) -> np.ndarray:
    """The probability of each distinct trigram of each text ``row`` by the counts of all other texts."""
    row = x["row"]
    less = x["n"] - x["own"]
    pair, of_pair = _numbered(row, x["b"], x["c"])
    gone = np.where(x["b"] == BEGIN, x["own"], less == 0)
    m = x["m"][pair]
    m_less = m - np.bincount(of_pair, gone).astype(np.int64)
    word, of_word = _numbered(row[pair], x["c"][pair])
    u = x["u"][pair][word]
    u_less = u - np.bincount(of_word, m_less == 0).astype(np.int64)
    p = _order(
        u, u_less, _numbered(row[pair][word])[1], language["total1"], [language[f"{k}1"] for k in _KINDS],
        language["discounts"][0], 1 / (language["words"] + 1),
    )
    p = _order(
        m, m_less, _numbered(row[pair], x["b"][pair])[1], x["total2"][pair], [x[f"{k}2"][pair] for k in _KINDS],
        language["discounts"][1], p[of_word],
    )
    return _order(
        x["n"], less, _numbered(row, x["a"], x["b"])[1], x["total3"], [x[f"{k}3"] for k in _KINDS],
        language["discounts"][2], p[of_pair],
    )


def _counted(x: Trigrams, times: np.ndarray, answers: list[dict], hot: np.ndarray, shards: int, heads: dict) -> dict[str, np.ndarray]:
    """The answers of all shards for the distinct trigrams of a block."""
    found = {name: np.zeros(len(x.a), np.int64) for name in _ORDER3 + _ORDER2}
    of = {(r["role"], r["slice"], r["shard"]): r for r in answers}
    for role, part, shard, index in _dealt(x, hot, shards, range(SLICES)):
        values = _unpacked(of[role, part, shard]["data"]).reshape(len(_COLUMNS[role]), -1)
        for name, value in zip(_COLUMNS[role], values, strict=True):
            found[name][index] = value
        if role != _SUFFIX:
            found["n"][index] += times[index]
        for k in {_WHOLE: (3, 2), _PREFIX: (3,), _SUFFIX: ()}[role]:
            once, twice, more = (found[f"{kind}{k}"][index] for kind in _KINDS)
            found[f"total{k}"][index] += once + 2 * twice + 3 * more
    for at in np.flatnonzero(np.isin(x.words, hot)):
        own = x.b == at
        if own.any():
            for name, value in zip(_ORDER2[1:], heads[int(x.words[at])], strict=True):
                found[name][own] = value
    u = np.empty(len(x.words), np.int64)
    for shard, own in _dealt_words(x.words, shards):
        u[own] = _unpacked(of[_WORDS, 0, shard]["data"])
    return found | {"u": u[x.c]}


def _scores(blocks: DataFrame, answers: DataFrame, hot: dict, shards: dict[str, int], sent) -> DataFrame:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        lang, language = row["lang"], sent.value[row["lang"]]
        x = _trigrams(row["words"], row["lengths"], row["tokens"])
        first, at, times = distinct(x.keys())
        counts = _counted(x.of(first), times, right.to_pylist(), hot.get(lang, np.zeros(0, np.int64)), shards[lang], language["heads"])
        ends = np.cumsum(_unpacked(row["lengths"]) + 1)
        sums, low = [], 0
        while low < len(ends):
            begin = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, begin + SCORED, side="right")))
            own, end = slice(begin, ends[high - 1]), ends[high - 1]
            texts = x.row[own] - low
            some, _, times = distinct(texts * len(first) + at[own])
            kept, of = texts[some], at[own][some]
            y = {name: value[of] for name, value in counts.items()}
            whole = x.of(np.arange(begin, end)[some])
            y |= {"row": kept, "own": times} | {k: x.words[getattr(whole, k)] for k in "abc"}
            surprise = -np.log(left_out(y, language))
            sums.append([np.bincount(kept, times * s) for s in (np.ones(len(some)), surprise, surprise * surprise)])
            low = high
        word_n, total, squares = (np.concatenate(s) for s in zip(*sums, strict=True))
        return pa.table({
            "h1": np.frombuffer(row["h1"], np.int64), "h2": np.frombuffer(row["h2"], np.int64),
            "lang": pa.array([lang] * len(word_n), pa.string()), "word_n": word_n.astype(np.int64),
            "word_surprise": total, "word_squares": squares,
        })

    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            score, "h1 bigint, h2 bigint, lang string, word_n bigint, word_surprise double, word_squares double"
        )
    )


def word_surprise(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """``(h1, h2, lang, word_n, word_surprise, word_squares)`` of each distinct text that has words.

    ``word_n`` counts its words and its end; the others sum their negative log
    probabilities and the squares of these. A bigram counts as often as there are
    words before it, or, at the beginning of a text, as often as it occurs.
    """
    with scratch(docs.sparkSession) as folder:
        blocks = token_blocks(docs, text_column, lang_column, folder)
        sizes = blocks.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks")).collect()
        shards = {r["lang"]: -(-r["n"] // (SHARD * SLICES)) for r in sizes}
        hot = _frequent(blocks, max([1, *(r["blocks"] for r in sizes)]))

        def answer(table: pa.Table) -> pa.Table:
            return _answer(table, shards[table["lang"][0].as_py()])

        answers = reduce(
            DataFrame.unionAll,
            [
                saved(_asked(blocks, hot, shards, k).groupBy("lang", "role", "shard").applyInArrow(answer, _REPLY), "word-answers", f"{folder}/word-answers-{k}")
                for k in range(SLICES)
            ],
        )
        counted = saved(_continuations(blocks, answers, shards), "word-continuations", f"{folder}/word-continuations")
        sent = docs.sparkSession.sparkContext.broadcast(_languages(answers, counted))
        scored = []
        for k in range(SLICES):
            mine = F.pmod(F.xxhash64("block"), F.lit(SLICES)) == k
            found = answers.unionAll(counted).where(F.col("block") >= 0).where(mine)
            scored.append(saved(_scores(blocks.where(mine), found, hot, shards, sent), "word-scores", f"{folder}/word-scores-{k}"))
        values = F.max(F.struct("word_n", "word_surprise", "word_squares")).alias("v")
        return checkpointed(reduce(DataFrame.unionAll, scored).groupBy(*TEXT).agg(values).select(*TEXT, "v.*"))
