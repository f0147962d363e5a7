"""A generalised additive model with pairwise interactions that tells good texts from bad ones.

Each of some twenty measures of a text is cut into bins and has a table with one number a
bin; some pairs of measures have a table of two coarser bins. A text's score is the sum of
the numbers it is looked up with. The tables are learned by cyclic boosting: in turn, every
measure fits a tree of depth two to what the others leave unexplained.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.wordhash import Words, chunks, mixed

SAMPLE = 20_000  # labelled texts that the model is learned from, at most
BINS = 32
COARSE = 8
PAIRS = 10
ROUNDS = 300
PAIR_ROUNDS = 100
PATIENCE = 25
RATE = 0.1
PENALTY = 1.0
LEAST_WEIGHT = 1.0

MEASURES = (
    "log_words chars_per_word symbol_share bar_words bangs_per_word upper_share capital_words distinct_words "
    "top_word adjacent_repeats distinct_pairs repeated_lines stops_per_word words_per_line short_words "
    "log_longest_word digit_share word_length_spread wide_share upper_words"
).split()
SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
BYTE = np.arange(256)
UPPER = (BYTE >= 65) & (BYTE <= 90)
LETTER = UPPER | ((BYTE >= 97) & (BYTE <= 122))
STOP = np.isin(BYTE, [ord(c) for c in ".,;:?"])
DIGIT = (BYTE >= 48) & (BYTE <= 57)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different keys each row has, and how often its most frequent one occurs."""
    _, first, times = np.unique(mixed(keys ^ mixed(rows.astype(np.uint64))), return_index=True, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, rows[first], times)
    return np.bincount(rows[first], minlength=n), most


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines of each row, and the share of them that repeat another."""
    n = len(words.first) - 1
    breaks = np.flatnonzero(words.data == 10)
    row = np.concatenate([np.searchsorted(words.bounds, breaks, side="right") - 1, np.arange(n)])
    ends = np.concatenate([breaks, words.bounds[1:]])
    order = np.lexsort((ends, row))
    row, ends = row[order], ends[order]
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1] + 1
    begins = np.concatenate([[True], row[1:] != row[:-1]]) if n else np.zeros(0, bool)
    starts[begins] = words.bounds[:-1]
    full = ends > starts
    lines = np.bincount(row, minlength=n)
    different, _ = _distinct(words.byte_runs(starts[full], ends[full]), row[full], n)
    filled = np.bincount(row[full], minlength=n)
    return lines, (filled - different) / np.maximum(filled, 1)


def measures(words: Words) -> np.ndarray:
    """One row of MEASURES a text, from all of it; an empty text has zeros."""
    data, n = words.data, len(words.first) - 1
    rows, length = words.rows(), (words.ends - words.starts).astype(np.float64)
    n_words = np.diff(words.first).astype(np.float64)
    per_word = np.maximum(n_words, 1)
    lead = (data & 0xC0) != 0x80
    chars = np.maximum(_sums(lead, words.bounds), 1)

    def share(wanted: np.ndarray) -> np.ndarray:
        return _sums(wanted, words.bounds)

    def word_share(wanted: np.ndarray) -> np.ndarray:
        return _sums(wanted, words.first) / per_word

    hashes = words.hashes()
    different, most = _distinct(hashes, rows, n)
    together = rows[1:] == rows[:-1]
    pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])[together]
    n_pairs = np.bincount(rows[1:][together], minlength=n)
    different_pairs, _ = _distinct(pairs, rows[1:][together], n)
    adjacent = np.bincount(rows[1:][together & (hashes[1:] == hashes[:-1])], minlength=n)
    lines, repeated = _lines(words)
    upper_in = np.concatenate([[0], np.cumsum(UPPER[data])])
    uppers = upper_in[words.ends] - upper_in[words.starts]
    letters_in = np.concatenate([[0], np.cumsum(LETTER[data])])
    letters = letters_in[words.ends] - letters_in[words.starts]
    longest = np.zeros(n)
    np.maximum.at(longest, rows, length)
    mean = _sums(length, words.first) / per_word
    spread = np.sqrt(np.maximum(_sums(length**2, words.first) / per_word - mean**2, 0))
    first_byte = data[words.starts] if len(words.starts) else data[:0]
    single = length == 1
    columns = [
        np.log1p(n_words),
        share(lead & (data > 0x20)) / per_word,
        share(SYMBOL[data]) / chars,
        word_share(single & (first_byte == ord("|"))),
        share(data == ord("!")) / per_word,
        share(UPPER[data]) / np.maximum(share(LETTER[data]), 1),
        word_share(UPPER[first_byte]),
        different / per_word,
        most / per_word,
        adjacent / per_word,
        different_pairs / np.maximum(n_pairs, 1),
        repeated,
        share(STOP[data]) / per_word,
        n_words / np.maximum(lines, 1),
        word_share(length <= 3),
        np.log1p(longest),
        share(DIGIT[data]) / chars,
        spread,
        share(data >= 0xC0) / chars,
        word_share((letters > 1) & (uppers == letters)),
    ]
    return np.stack(columns, axis=1)


def _leaves(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """What a tree over neighbouring bins gives each bin: the split of the largest gain, twice."""
    whole = gradient.sum() / (weight.sum() + PENALTY)
    found = np.full(len(gradient), whole)
    if depth and len(gradient) > 1:
        left, lower = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
        right, upper = gradient.sum() - left, weight.sum() - lower
        gain = left**2 / (lower + PENALTY) + right**2 / (upper + PENALTY)
        gain[(lower < LEAST_WEIGHT) | (upper < LEAST_WEIGHT)] = -1
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > whole * gradient.sum() + 1e-9:
            found[:cut] = _leaves(gradient[:cut], weight[:cut], depth - 1)
            found[cut:] = _leaves(gradient[cut:], weight[cut:], depth - 1)
    return found


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a table of two measures into four, its gain and what it gives each cell."""

    def corners(cells: np.ndarray) -> np.ndarray:
        low = cells.cumsum(0).cumsum(1)
        first, second = low[:-1, -1:], low[-1:, :-1]
        both = low[:-1, :-1]
        return np.stack([both, first - both, second - both, low[-1, -1] - first - second + both])

    if min(gradient.shape) < 2:
        return 0.0, np.zeros_like(gradient)
    g, h = corners(gradient), corners(weight)
    gain = (g**2 / (h + PENALTY)).sum(0)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = g[:, i, j] / (h[:, i, j] + PENALTY)
    found = np.empty_like(gradient)
    i, j = i + 1, j + 1
    found[:i, :j], found[:i, j:], found[i:, :j], found[i:, j:] = value
    return float(gain.max()), found


@dataclass
class Model:
    """``edges[m]``: where the bins of measure ``m`` end; ``coarse``: the same for pairs."""

    base: float
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for m, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, m], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            row = np.searchsorted(self.coarse[i], x[:, i], side="right")
            total += table[row, np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return _sigmoid(total)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _loss(y: np.ndarray, total: np.ndarray) -> float:
    p = np.clip(_sigmoid(total), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, checked: np.ndarray) -> Model:
    """Learned from the rows that are not ``checked``; the round that is best on those is kept.

    Without both labels every text scores the share of label 1, a half if there is none.
    """
    known, rate = ~checked, float(y.mean()) if len(y) else 0.5
    base = float(np.log((rate + 1e-6) / (1 - rate + 1e-6)))
    m = x.shape[1]
    model = Model(
        base,
        [_edges(x[:, k], BINS) if len(x) else np.zeros(0) for k in range(m)],
        [_edges(x[:, k], COARSE) if len(x) else np.zeros(0) for k in range(m)],
        [],
        [],
        [],
    )
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(np.unique(y[known])) < 2:
        return model
    if not checked.any():
        checked = known
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    total = np.full(len(y), base)

    def histogram(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(total[known])
        return np.bincount(at[known], y[known] - p, n), np.bincount(at[known], p * (1 - p), n)

    def boosted(tables: list[np.ndarray], places: list[np.ndarray], tree, rounds: int) -> list[np.ndarray]:
        best, kept, kept_total, since = _loss(y[checked], total[checked]), [t.copy() for t in tables], total.copy(), 0
        for _ in range(rounds):
            for table, at in zip(tables, places, strict=True):
                step = RATE * tree(*histogram(at, table.size), table.shape)
                table += step
                total[:] += step.ravel()[at]
            loss = _loss(y[checked], total[checked])
            if loss < best - 1e-6:
                best, kept, kept_total, since = loss, [t.copy() for t in tables], total.copy(), 0
            elif (since := since + 1) >= PATIENCE:
                break
        total[:] = kept_total
        return kept

    model.tables = boosted(model.tables, bins, lambda g, h, _: _leaves(g, h, 2), ROUNDS)
    wide = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def quadrants(g: np.ndarray, h: np.ndarray, shape: tuple[int, int]) -> tuple[float, np.ndarray]:
        return _quadrants(g.reshape(shape), h.reshape(shape))

    cells = {(i, j): wide[i] * sizes[j] + wide[j] for i, j in combinations(range(m), 2)}
    shapes = {(i, j): (sizes[i], sizes[j]) for i, j in cells}
    gains = {c: quadrants(*histogram(at, int(np.prod(shapes[c]))), shapes[c])[0] for c, at in cells.items()}
    model.pairs = sorted(sorted(gains), key=lambda c: -gains[c])[:PAIRS]
    start = [np.zeros(shapes[c]) for c in model.pairs]
    places = [cells[c] for c in model.pairs]
    model.pair_tables = boosted(start, places, lambda g, h, shape: quadrants(g, h, shape)[1], PAIR_ROUNDS)
    return model


def _measured(texts: pa.Array) -> np.ndarray:
    parts = [measures(words) for _, _, words in chunks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(MEASURES)))


def learned(
    docs: DataFrame, labels: DataFrame, text_column: str, id_column: str, label_column: str, sample: int
) -> Model:
    """The model of at most ``sample`` labelled ids, those of the smallest hashes.

    An id's label is 1 if at least half of its labels are; a fifth of the ids only choose how
    many rounds are kept. Of texts with the same id one counts.
    """
    marks = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("label_id"))
        .agg((F.avg(label_column) >= 0.5).cast("int").alias("mark"))
        .withColumn("draw", F.xxhash64(F.lit("additive"), F.col("label_id").cast("string")))
        .orderBy("draw", "label_id")
        .limit(sample)
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_measured(batch.column(0)))
            values = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, *batch.columns[1:]], ["measures", "draw", "mark"])

    # At most ``sample`` rows of two numbers each, so they can be sent to every task.
    texts = docs.select(F.col(id_column).alias("text_id"), F.col(text_column).cast("string").alias("text"))
    rows = texts.join(F.broadcast(marks), F.col("text_id") == F.col("label_id")).select("text", "draw", "mark")
    schema = "measures array<double>, draw bigint, mark int"
    found = rows.mapInArrow(measure, schema).groupBy("draw", "mark").agg(F.min("measures").alias("measures"))
    table = sorted((r["draw"], r["mark"], r["measures"]) for r in found.collect())
    x = np.array([r[2] for r in table], float).reshape(len(table), len(MEASURES))
    y = np.array([r[1] for r in table], float)
    return fit(x, y, np.arange(len(y)) % 5 == 4)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    text_column: str = "text",
    id_column: str = "doc_id",
    label_column: str = "quality",
    carried: Sequence[str] | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """``(row, score)`` of each document: how likely its whole text has label 1.

    ``row`` is a struct of the ``carried`` columns (all by default), so no name clashes. Only
    the text enters the score: equal texts score the same, NULL counts as empty, and an empty
    text scores what its zero measures give. ``labels`` are those to learn from; labels
    without a document, NULL labels and NULL ids teach nothing. Without both kinds every text
    scores the share of label 1, and a half without any. No documents give no rows. A text
    is measured whole, at some 50 bytes of memory for each of its bytes.
    """
    model = learned(docs, labels, text_column, id_column, label_column, sample)
    row = F.struct(*[F.col(c) for c in (docs.columns if carried is None else carried)])
    rows = docs.select(row.alias("row"), F.col(text_column).cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(model.score(_measured(batch.column(1))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["row", "score"])

    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(score, schema)
