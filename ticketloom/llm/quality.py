"""Quality rules: repetition and length counts, and perplexity bands by language.

A text's perplexity is that of its words in their order (``wordmodel``), whose tables
grow with the corpus. A second model judges spelling and has characters as its unit:
every word is a sequence of symbols out of 64 between two boundaries, and a modified
Kneser-Ney model of order 4 is counted and estimated by Spark for each language. Its
n-grams are packed into integers that hash without collisions and are kept in sorted
arrays. Both models can reject a text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.shared import checkpointed, free_name, saved
from ticketloom.llm.wordhash import Words, chunks, distinct, mixed
from ticketloom.llm.wordmodel import text_prints, word_surprise

ORDER = 4
BITS = 6
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FENCE = 3.0
ERRORS = 4.0
MODEL_ENTRIES = 24_000_000  # sent to the tasks at once, 8 bytes each; one language stays below

METRICS = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_scored")
    ]
    + [T.StructField(name, T.DoubleType()) for name in ("surprise", "squares")]
)


def _symbols() -> np.ndarray:
    """The symbol of each first byte; 0 is a word's boundary."""
    table = np.full(256, 35, np.uint8)
    for letter in range(26):
        table[ord("a") + letter] = table[ord("A") + letter] = 1 + letter
    table[[ord(c) for c in "0123456789"]] = 27
    for symbol, characters in enumerate([".", ",", "-'", "!?", ";:", "#*$%&|<>", "()[]{}\"/"], 28):
        table[[ord(c) for c in characters]] = symbol
    return table


SYMBOLS = _symbols()
MARKS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])


def packed_ngrams(words: Words, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams that end at each character and at the end of the words ``of``, and
    where each word's begin. Characters beyond ASCII share 28 symbols."""
    data = words.data
    lead = (data & 0xC0) != 0x80
    symbol = SYMBOLS[data]
    wide = np.flatnonzero(data >= 0xC0)
    second = data[np.minimum(wide + 1, len(data) - 1)].astype(np.int64)
    symbol[wide] = 36 + (data[wide].astype(np.int64) * 5 + second) % 28
    place = np.concatenate([[0], np.cumsum(lead)])
    symbol = symbol[lead]
    begin, length = place[words.starts[of]], place[words.ends[of]] - place[words.starts[of]]
    pad = ORDER - 1
    offsets = np.concatenate([[0], np.cumsum(length + ORDER)])
    padded = np.zeros(offsets[-1], np.uint32)
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    padded[np.repeat(offsets[:-1] + pad, length) + inner] = symbol[np.repeat(begin, length) + inner]
    grams = padded.copy()
    for back in range(1, ORDER):
        grams[back:] |= padded[:-back] << np.uint32(BITS * back)
    wanted = np.ones(len(padded), bool)
    for k in range(pad):
        wanted[offsets[:-1] + k] = False
    return grams[wanted], offsets[:-1] - pad * np.arange(len(of))


def _distinct_words(words: Words, language: np.ndarray):
    """First place, inverse and count of the distinct words by language."""
    key = mixed(words.hashes() ^ language[words.rows()].astype(np.uint64), 3)
    return distinct(key)


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Languages as numbers; NULL is the language ''."""
    coded = pc.fill_null(column.cast(pa.string()), "").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def _field(rows: pa.StructArray, name: str) -> pa.Array:
    return rows.field(rows.type.get_field_index(name))


def ngram_counts(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """``(lang, gram, n)``: how often each n-gram of the highest order occurs, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, names = _coded(batch.column(1))
            keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for low, high, words in chunks(batch.column(0)):
                language = codes[low:high]
                index, _, times = _distinct_words(words, language)
                grams, begins = packed_ngrams(words, index)
                each = np.diff(np.append(begins, len(grams)))
                key = grams.astype(np.int64) | (
                    np.repeat(language[words.rows()[index]].astype(np.int64), each) << (ORDER * BITS)
                )
                one, at, _ = distinct(key)
                keys.append(key[one])
                counts.append(np.bincount(at, np.repeat(times, each), len(one)).astype(np.int64))
            found = np.concatenate(keys)
            one, at, _ = distinct(found)
            found = found[one]
            total = np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in found >> (ORDER * BITS)], pa.string()),
                    pa.array(found & ((1 << (ORDER * BITS)) - 1)),
                    pa.array(total),
                ],
                ["lang", "gram", "n"],
            )

    texts = docs.select(F.col(text_column).cast("string"), F.col(lang_column).cast("string"))
    partial = texts.mapInArrow(count, "lang string, gram bigint, n bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounted(grams: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` with each n-gram's discounted share and its context's back-off weight.

    The three discounts come from how many n-grams of the language occur one to four
    times; where those counts cannot give them they are 0.5, 1 and 1.5.
    """
    times = [F.count_if(F.col("n") == k).cast("double") for k in (1, 2, 3, 4)]
    of_lang = grams.groupBy("lang").agg(*[t.alias(f"n{k}") for k, t in enumerate(times, 1)])
    ratio = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    discounts = [
        F.coalesce(
            F.greatest(
                F.lit(0.1),
                F.least(F.lit(float(k)), k - (k + 1) * ratio * F.try_divide(f"n{k + 1}", f"n{k}")),
            ),
            F.lit(0.5 * k),
        ).alias(f"d{k}")
        for k in (1, 2, 3)
    ]
    of_lang = of_lang.select("lang", *discounts)
    context = F.shiftright("gram", BITS)
    contexts = grams.groupBy("lang", context.alias("context")).agg(
        F.sum("n").alias("total"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
        F.count_if(F.col("n") > 2).alias("more"),
    )
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    weight = F.col("d1") * F.col("once") + F.col("d2") * F.col("twice") + F.col("d3") * F.col("more")
    return (
        grams.withColumn("context", context)
        .join(contexts, ["lang", "context"])
        .join(of_lang, "lang")
        .select(
            "lang",
            "gram",
            "context",
            ((F.col("n") - discount) / F.col("total")).alias("share"),
            (weight / F.col("total")).alias("weight"),
        )
    )


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``(lang, kind, order, gram, value)``: log probabilities (kind 0) and back-off weights (1).

    Below the highest order an n-gram counts as often as there are symbols before it,
    or, if it begins at a word's start, as often as it occurs.
    """
    grams, levels = counts.select("lang", "gram", "n", F.col("n").alias("raw")), []
    for order in range(ORDER, 0, -1):
        grams = checkpointed(grams)
        levels.append((order, grams))
        if order > 1:
            shorter = F.col("gram").bitwiseAND((1 << BITS * (order - 1)) - 1)
            grams = grams.groupBy("lang", shorter.alias("gram")).agg(
                F.count(F.lit(1)).alias("before"), F.sum("raw").alias("raw")
            )
            starts = F.lit(order > 2) & (F.shiftright("gram", BITS * (order - 2)) == 0)
            grams = grams.select(
                "lang", "gram", F.when(starts, F.col("raw")).otherwise(F.col("before")).alias("n"), "raw"
            )
    lower, parts = None, []
    for order, grams in reversed(levels):
        found = _discounted(grams.select("lang", "gram", "n"))
        if lower is None:
            below = F.lit(1.0 / (1 << BITS))
        else:
            found = found.withColumn(
                "shorter", F.col("gram").bitwiseAND((1 << BITS * (order - 1)) - 1)
            ).join(lower, ["lang", "shorter"])
            below = F.col("lower_p")
        found = checkpointed(found.withColumn("p", F.col("share") + F.col("weight") * below))
        lower = found.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("lower_p"))
        parts.append(
            found.select("lang", F.lit(0).alias("kind"), F.lit(order).alias("order"), "gram", F.ln("p").alias("value"))
        )
        parts.append(
            found.groupBy("lang", "context")
            .agg(F.max(F.ln("weight")).alias("value"))
            .select("lang", F.lit(1).alias("kind"), F.lit(order - 1).alias("order"), F.col("context").alias("gram"), "value")
        )
    return reduce(DataFrame.unionAll, parts)


@dataclass
class Model:
    """Sorted n-grams and their values: ``grams[order]`` for probabilities, ``weights[order]`` for back-off."""

    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    weights: dict[int, tuple[np.ndarray, np.ndarray]]

    def log_probability(self, packed: np.ndarray) -> np.ndarray:
        """Of the last symbol of each packed n-gram given those before it."""
        result = np.zeros(len(packed))
        rest = np.arange(len(packed))
        for order in range(ORDER, 0, -1):
            gram = packed[rest] & np.uint32((1 << BITS * order) - 1)
            value, hit = _look_up(self.grams[order], gram)
            result[rest[hit]] += value[hit]
            rest, gram = rest[~hit], gram[~hit]
            value, hit = _look_up(self.weights[order - 1], gram >> np.uint32(BITS))
            result[rest[hit]] += value[hit]
        result[rest] -= np.log(1 << BITS)
        return result


def _look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams, values = table
    at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
    return values[at], grams[at] == keys


def _models(entries: DataFrame) -> dict[str, Model]:
    rows = entries.orderBy("lang", "kind", "order", "gram").toArrow()
    lang = np.asarray(rows["lang"].to_pylist(), object)
    kind, order = rows["kind"].to_numpy(), rows["order"].to_numpy()
    gram = rows["gram"].to_numpy().astype(np.uint32)
    value = rows["value"].to_numpy().astype(np.float32)
    models = {}
    for name in dict.fromkeys(lang):
        tables: tuple[dict, dict] = ({}, {})
        for k, first in ((0, 1), (1, 0)):
            for o in range(first, first + ORDER):
                own = (lang == name) & (kind == k) & (order == o)
                tables[k][o] = gram[own], value[own]
        models[name] = Model(*tables)
    return models


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def _base_counts(words: Words) -> list[np.ndarray]:
    data, n_rows = words.data, len(words.first) - 1
    row = words.rows()
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    word_chars = _sums(inside & ((data & 0xC0) != 0x80), words.bounds)
    n_symbols = _sums(MARKS[data], words.bounds)

    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([words.bounds[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.minimum(np.append(line_starts[1:], len(data)), len(data))
    ended = (line_ends > line_starts) & (data[line_ends - 1] == 10) if len(data) else np.zeros(0, bool)
    line_ends = line_ends - ended
    worded = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_row = (np.searchsorted(words.bounds, line_starts, side="right") - 1).astype(np.uint64)
    key = mixed(words.byte_runs(line_starts, line_ends) ^ mixed(line_row, 5), 6)
    first = distinct(key)[0]
    lines = np.bincount(line_row.astype(np.int64), minlength=n_rows)
    n_dup_lines = lines - np.bincount(line_row[first].astype(np.int64), minlength=n_rows)

    n = len(words.starts)
    covered = np.zeros(n, bool)
    if n > 2:
        h = words.hashes()
        window = mixed(mixed(mixed(h[:-2], 1) ^ h[1:-1], 2) ^ h[2:], 3)
        whole = row[:-2] == row[2:]
        key = mixed(window ^ mixed(row[:-2].astype(np.uint64), 8), 9)[whole]
        _, at, times = distinct(key)
        repeated = np.flatnonzero(whole)[times[at] > 1]
        for k in range(3):
            covered[repeated + k] = True
    n_repeat = np.bincount(row[covered], minlength=n_rows)
    return [np.diff(words.first), word_chars, n_symbols, n_dup_lines, n_repeat]


def measured(
    docs: DataFrame,
    models: dict[str, Model],
    carried: Sequence[str],
    text_column: str,
    lang_column: str,
) -> DataFrame:
    """``row`` (the carried columns), ``language`` and the counts of METRICS for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(models)
    used = list(dict.fromkeys([*carried, text_column, lang_column]))
    kept_type = T.StructType([docs.schema[c] for c in carried])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        for batch in batches:
            rows = batch.column(0)
            codes, names = _coded(_field(rows, lang_column))
            parts = []
            for low, high, words in chunks(_field(rows, text_column).cast(pa.string())):
                language = codes[low:high]
                index, at, _ = _distinct_words(words, language)
                grams, begins = packed_ngrams(words, index)
                lang_of = language[words.rows()[index]]
                each = np.diff(np.append(begins, len(grams)))
                surprise = np.zeros(len(grams))
                of_gram = np.repeat(lang_of, each)
                for code in np.unique(lang_of):
                    own = of_gram == code
                    one, at_gram, _ = distinct(grams[own])  # ascending, as look-ups like them
                    surprise[own] = -models[names[code]].log_probability(grams[own][one])[at_gram]
                sums = [
                    np.add.reduceat(x, begins)[at] if len(at) else np.zeros(0)
                    for x in (surprise, surprise * surprise)
                ]
                parts.append(
                    [*_base_counts(words), _sums(each[at], words.first), *(_sums(x, words.first) for x in sums)]
                )
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[]] * len(METRICS)
            arrays = [
                pa.array(c, pa.int64() if f.dataType == T.LongType() else pa.float64())
                for c, f in zip(columns, METRICS, strict=True)
            ]
            kept = pa.StructArray.from_arrays([_field(rows, c) for c in carried], list(carried))
            yield pa.RecordBatch.from_arrays(
                [kept, pa.array([names[c] for c in codes], pa.string()), *arrays],
                ["row", "language", *METRICS.names],
            )

    schema = T.StructType([T.StructField("row", kept_type), T.StructField("language", T.StringType()), *METRICS])
    return docs.select(F.struct(*used).alias("row")).mapInArrow(measure, schema)


def _scored(docs, counts, carried, text_column, lang_column) -> DataFrame:
    """Measure with the models of as many languages at a time as MODEL_ENTRIES allows."""
    entries = saved(kneser_ney(counts), "language-model")
    groups: list[list[str]] = [[]]
    size = 0
    for row in entries.groupBy("lang").count().orderBy("lang").collect():
        if groups[-1] and size + row["count"] > MODEL_ENTRIES:
            groups.append([])
            size = 0
        groups[-1].append(row["lang"])
        size += row["count"]
    if len(groups) == 1:
        return measured(docs, _models(entries), carried, text_column, lang_column)
    language = F.coalesce(F.col(lang_column).cast("string"), F.lit(""))
    return reduce(
        DataFrame.unionAll,
        [
            measured(
                docs.where(language.isin(group)),
                _models(entries.where(F.col("lang").isin(group))),
                carried,
                text_column,
                lang_column,
            )
            for group in groups
        ],
    )


def perplexity_bands(scored: DataFrame) -> DataFrame:
    """``(language, low, high, deviation)``: fences of the mean surprise and its deviation per symbol.

    The quartiles are read off counts of the mean surprise in steps of a thousandth
    over the documents that pass the base rules; the fences lie ``FENCE`` quartile
    distances beyond them.
    """
    base = scored.where("NOT base_failed AND n_scored > 0")
    steps = base.groupBy(
        "language", F.round(F.col("surprise") / F.col("n_scored") * 1000).cast("bigint").alias("step")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("n_scored").alias("n_scored"),
        F.sum("surprise").alias("surprise"),
        F.sum("squares").alias("squares"),
    )
    quartiles = F.percentile("step", F.array(F.lit(0.25), F.lit(0.75)), F.col("n"))
    mean = F.sum("surprise") / F.sum("n_scored")
    of_lang = steps.groupBy("language").agg(
        (quartiles[0] / 1000).alias("q1"),
        (quartiles[1] / 1000).alias("q3"),
        F.sqrt(F.greatest(F.lit(0.0), F.sum("squares") / F.sum("n_scored") - mean * mean)).alias("deviation"),
    )
    reach = FENCE * (F.col("q3") - F.col("q1"))
    return of_lang.select(
        "language", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"), "deviation"
    )


def word_limits(scored: DataFrame) -> DataFrame:
    """``(language, word_high, word_deviation)``: the upper fence of the mean surprise of words.

    It lies twice ``FENCE`` distances of median and upper quartile beyond that quartile, so
    copied texts, which others make likely, do not widen it.
    """
    base = scored.where("NOT base_failed AND word_n > 0")
    steps = base.groupBy(
        "language", F.round(F.col("word_surprise") / F.col("word_n") * 1000).cast("bigint").alias("step")
    ).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("word_n", "word_surprise", "word_squares")]
    )
    quartiles = F.percentile("step", F.array(F.lit(0.5), F.lit(0.75)), F.col("n"))
    mean = F.sum("word_surprise") / F.sum("word_n")
    variance = F.sum("word_squares") / F.sum("word_n") - mean * mean
    return steps.groupBy("language").agg(
        ((quartiles[1] + 2 * FENCE * (quartiles[1] - quartiles[0])) / 1000).alias("word_high"),
        F.sqrt(F.greatest(F.lit(0.0), variance)).alias("word_deviation"),
    )


def quality_rules(
    docs: DataFrame,
    carried: Sequence[str] | None = None,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """``row`` (the carried columns, all by default), base counts, ``perplexity``, ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words lie in 3-word
    windows that occur twice or more in the text. A document that passes is rejected
    if the mean surprise of its words (the logarithm of its perplexity, by all other
    texts) lies above the fence of its language, or that of its characters outside
    their band, by more than ``ERRORS`` standard errors of a text of its length. A
    NULL or wordless text has counts of 0, a NULL perplexity and fails; a NULL
    language is a language of its own; repeated rows are judged alike; an empty table
    gives an empty result. Extra columns stay inside ``row``, whatever their names.
    """
    carried = list(docs.columns if carried is None else carried)
    prints = dict(zip([free_name(docs, "print1"), free_name(docs, "print2")], text_prints(text_column), strict=True))
    printed = docs.withColumns(prints)
    counts = checkpointed(ngram_counts(docs, text_column, lang_column))
    words = word_surprise(docs, text_column, lang_column)
    measures = _scored(printed, counts, [*carried, *prints], text_column, lang_column)
    field = F.col("row").getField
    measures = measures.select(
        F.struct(*[field(c).alias(c) for c in carried]).alias("row"),
        "language",
        *METRICS.names,
        *[field(c).alias(h) for c, h in zip(prints, ("h1", "h2"), strict=True)],
    )
    by_text = ["h1", "h2", "language"]
    scored = saved(
        measures.join(words.withColumnRenamed("lang", "language"), by_text, "left").drop("h1", "h2"), "scored"
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )
    bands = F.broadcast(checkpointed(perplexity_bands(scored)))  # one row a language
    limits = F.broadcast(checkpointed(word_limits(scored)))
    n_scored = F.when(F.col("n_scored") > 0, F.col("n_scored"))
    mean = F.col("surprise") / n_scored
    slack = ERRORS * F.col("deviation") / F.sqrt(n_scored)
    inside = (mean >= F.col("low") - slack) & (mean <= F.col("high") + slack)
    word_mean = F.col("word_surprise") / F.col("word_n")
    likely = word_mean <= F.col("word_high") + ERRORS * F.col("word_deviation") / F.sqrt("word_n")
    return scored.join(bands, "language", "left").join(limits, "language", "left").select(
        "row",
        *METRICS.names[:5],
        "base_failed",
        F.exp(word_mean).alias("perplexity"),
        (~F.col("base_failed") & F.coalesce(inside & likely, F.lit(False))).alias("kept"),
    )
