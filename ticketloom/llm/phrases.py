"""Substring deduplication with repeated-phrase automata.

The least 8-word phrase of a 35-word window is its anchor, so equal windows have equal
anchors. Phrases that are anchors twice or more name the candidate windows, whose
prints are counted to confirm those that recur. The anchors are dealt into shards by
the smallest document that has them, which keeps a passage together (the many of a long
document are dealt in parts); each shard's phrases become one Aho-Corasick automaton, and the documents that have any of them are
streamed through it to find every occurrence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.shared import checkpointed, saved
from ticketloom.llm.wordhash import Words, chunks, mixed, run_hashes

WINDOW = 35
PHRASE = 8
SHARD_PHRASES = 20_000  # of one automaton
GROUP_BYTES = 16 << 20  # of the texts that one task streams through it at a time

ANCHORS = "array<struct<phrase:bigint, shard:int>>"


class Anchored:
    """The phrases, windows and anchors of the rows of a chunk."""

    def __init__(self, words: Words) -> None:
        self.words = words
        hashes = words.hashes()
        n = len(hashes)
        self._hashes = hashes
        at = np.arange(max(n - PHRASE + 1, 0))
        self.phrases = run_hashes(hashes, at, at + PHRASE)
        starts = np.arange(max(n - WINDOW + 1, 0))
        row = words.rows()
        self.windows = starts[row[: len(starts)] == row[WINDOW - 1 :]] if len(starts) else starts
        self.anchors = self._least_phrases()[self.windows] if len(self.windows) else self.windows

    def _least_phrases(self) -> np.ndarray:
        """The place of the least phrase of each window, the first of equal ones."""
        reach, place = 1, np.arange(len(self.phrases))

        def lesser(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            return np.where(self.phrases[left] <= self.phrases[right], left, right)

        span = WINDOW - PHRASE + 1
        while 2 * reach <= span:
            place = lesser(place[:-reach], place[reach:])
            reach *= 2
        rest = span - reach
        return lesser(place[: len(place) - rest], place[rest:]) if rest else place

    def window_prints(self, starts: np.ndarray) -> np.ndarray:
        return run_hashes(self._hashes, starts, starts + WINDOW)

    def row_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words.first, place, side="right") - 1


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """``(doc_id, text_print, phrase)`` for every anchor of every text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in chunks(batch.column(2)):
                found = Anchored(words)
                places = np.unique(found.anchors)
                rows = pa.array(found.row_of(places) + low)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(found.phrases[places].view(np.int64)),
                    ],
                    ["doc_id", "text_print", "phrase"],
                )

    return texts.mapInArrow(find, "doc_id bigint, text_print bigint, phrase bigint")


def _kept(text: bytes, keep: np.ndarray | None = None) -> tuple[int, str]:
    """Number of words, and the digest of the kept ones joined by blanks."""
    words = text.split()
    left = words if keep is None else [w for w, k in zip(words, keep, strict=True) if k]
    return len(words), hashlib.sha256(b" ".join(left)).hexdigest()


def _counted(rows: DataFrame) -> DataFrame:
    """Every row with its number of words; one without recurring phrases with its digest,
    the others with their texts for what follows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, text, anchors = batch.columns
            candidate = anchors.is_valid().to_pylist()
            n_words, digests = [], []
            for value, wanted in zip(text, candidate, strict=True):
                n, digest = _kept(value.as_buffer().to_pybytes() if value.is_valid else b"")
                n_words.append(n)
                digests.append(None if wanted else digest)
            texts = [t.as_py() if wanted else None for t, wanted in zip(text, candidate, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(n_words, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string()), anchors],
                ["doc_id", "n_words", "kept_sha256", "text", "anchors"],
            )

    out = f"doc_id bigint, n_words bigint, kept_sha256 string, text string, anchors {ANCHORS}"
    return saved(
        rows.mapInArrow(count, out).withColumn("row_id", F.monotonically_increasing_id()), "phrase-rows"
    )


class Recurring:
    """The recurring phrases of a batch's texts, sorted, with their shards."""

    def __init__(self, anchors: pa.ListArray) -> None:
        each = anchors.flatten()
        phrases = each.field("phrase").to_numpy()
        self.phrases, first = np.unique(phrases, return_index=True)
        self.shards = each.field("shard").to_numpy()[first]

    def places(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``phrases`` recur, and the place of each of those here."""
        at = np.searchsorted(self.phrases, phrases)
        inside = at < len(self.phrases)
        inside[inside] = self.phrases[at[inside]] == phrases[inside]
        return inside, at[inside]


def _candidate_windows(candidates: DataFrame) -> DataFrame:
    """``(window, check)`` for every window whose anchor recurs; the low half of ``check`` is the shard."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recurring = Recurring(batch.column(1))
            for _, _, words in chunks(batch.column(0)):
                found = Anchored(words)
                phrase = found.phrases[found.anchors].view(np.int64)
                recurs, at = recurring.places(phrase)
                prints = found.window_prints(found.windows[recurs])
                check = (mixed(prints ^ phrase[recurs].view(np.uint64)) >> np.uint64(33)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints.view(np.int64)), pa.array(check << 32 | recurring.shards[at])],
                    ["window", "check"],
                )

    return candidates.select("text", "anchors").mapInArrow(emit, "window bigint, check bigint")


def _phrase_texts(candidates: DataFrame) -> DataFrame:
    """``(shard, phrase, words)``: the words of the recurring anchors, from texts that have them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recurring = Recurring(batch.column(1))
            seen = np.zeros(len(recurring.phrases), bool)
            for _, _, words in chunks(batch.column(0)):
                found = Anchored(words)
                places = np.unique(found.anchors)
                recurs, at = recurring.places(found.phrases[places].view(np.int64))
                at, first = np.unique(at, return_index=True)
                places, at = places[recurs][first][~seen[at]], at[~seen[at]]
                seen[at] = True
                spans = zip(words.starts[places], words.ends[places + PHRASE - 1], strict=True)
                texts = [b" ".join(words.data[x:y].tobytes().split()).decode() for x, y in spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(recurring.shards[at]), pa.array(recurring.phrases[at]), pa.array(texts, pa.string())],
                    ["shard", "phrase", "words"],
                )

    return (
        candidates.select("text", "anchors")
        .mapInArrow(emit, "shard int, phrase bigint, words string")
        .dropDuplicates(["phrase"])
    )


def _streamed(left: pa.Table, right: pa.Table) -> pa.Table:
    """The runs of words ``[begins, ends)`` of each text that recurring windows of a shard cover."""
    windows = np.sort(right["window"].drop_null().to_numpy())
    automaton = ahocorasick.Automaton()
    for words in right["words"].drop_null().to_pylist():
        automaton.add_word(f" {words} ", len(words) + 2)
    begins, ends = [], []
    if len(automaton) and len(windows):
        automaton.make_automaton()
        for low, high, words in chunks(left["text"]):
            found = Anchored(words)
            covered = np.zeros(len(words.starts) + 1, np.int64)
            for row in range(high - low):
                own = slice(words.first[row], words.first[row + 1])
                text = left["text"][low + row].as_py()
                near = _near_phrases(automaton, text, own.stop - own.start) + own.start
                if len(near):
                    prints = found.window_prints(near).view(np.int64)
                    at = np.minimum(np.searchsorted(windows, prints), len(windows) - 1)
                    hits = near[windows[at] == prints]
                    np.add.at(covered, hits, 1)
                    np.add.at(covered, hits + WINDOW, -1)
            inside = np.cumsum(covered[:-1]) > 0
            for row in range(high - low):
                own = inside[words.first[row] : words.first[row + 1]].astype(np.int8)
                steps = np.diff(np.concatenate([[0], own, [0]]))
                begins.append(np.flatnonzero(steps == 1).astype(np.int32))
                ends.append(np.flatnonzero(steps == -1).astype(np.int32))
    else:
        begins = ends = [np.zeros(0, np.int32)] * len(left)
    runs = pa.list_(pa.int32())
    return pa.table({"row_id": left["row_id"], "begins": pa.array(begins, runs), "ends": pa.array(ends, runs)})


def _near_phrases(automaton: ahocorasick.Automaton, text: str, n_words: int) -> np.ndarray:
    """Starts of the windows around the phrases that the automaton finds in a text of ``n_words`` words."""
    words = text.encode().split()
    line = " " + b" ".join(words).decode() + " "
    blanks = np.cumsum([0, *(len(w.decode()) + 1 for w in words)])
    at = [end - length + 1 for end, length in automaton.iter(line)]
    places = np.searchsorted(blanks, np.unique(np.asarray(at, np.int64)))
    near = np.zeros(n_words + 1, np.int64)
    np.add.at(near, np.maximum(places - (WINDOW - PHRASE), 0), 1)
    np.add.at(near, places + 1, -1)
    return np.flatnonzero(np.cumsum(near)[: max(n_words - WINDOW + 1, 0)] > 0)


def _applied(rows: DataFrame) -> DataFrame:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests = [], []
            for n, text, runs in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                keep = np.ones(n, bool)
                for run in runs or []:
                    for begin, end in zip(run["begins"], run["ends"], strict=True):
                        keep[begin:end] = False
                removed.append(int(n - keep.sum()))
                digests.append(_kept(text.as_buffer().to_pybytes(), keep.tolist())[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return rows.mapInArrow(apply, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def _sharded(recurring: DataFrame, n_shards: int) -> DataFrame:
    """``(phrase, shard)``: the phrases of an owner in one shard, or, if they are more than a
    quarter of what one holds, in parts of so many."""
    part = max(1, SHARD_PHRASES // 4)
    many = (
        recurring.groupBy("owner")
        .agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))
        .where("parts > 1")
    )
    share = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("phrase"), "parts")).otherwise(0)
    shard = F.pmod(F.xxhash64("owner", share), F.lit(n_shards)).cast("int")
    return recurring.join(many, "owner", "left").select("phrase", shard.alias("shard"))


def _runs(candidates: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(row_id, begins, ends)``: every candidate through the automata of its shards.

    The sizes of the groups, a row per shard, are broadcast: in a shuffled join the texts
    would be shuffled once for it and once more for their groups.
    """
    routed = candidates.select("row_id", "text", F.explode(F.array_distinct("anchors.shard")).alias("shard"))
    groups = F.broadcast(
        checkpointed(
            routed.groupBy("shard")
            .agg(F.ceil(F.sum(F.octet_length("text")) / GROUP_BYTES).cast("int").alias("n_groups"))
        )
    )
    left = routed.join(groups, "shard").select(
        "shard", F.pmod(F.xxhash64("row_id"), "n_groups").cast("int").alias("group_"), "row_id", "text"
    )
    right = patterns.join(groups, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)).alias("group_"), "window", "words"
    )
    return (
        left.groupBy("shard", "group_")
        .cogroup(right.groupBy("shard", "group_"))
        .applyInArrow(_streamed, "row_id bigint, begins array<int>, ends array<int>")
    )


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for every row of ``docs``.

    A word is removed if it lies in a window of 35 consecutive words of the row whose
    words also start anywhere else, in the same text or another; also a row that
    repeats another counts as another. ``kept_sha256`` is the digest of the kept words
    joined by single blanks. NULL or short texts lose nothing. Other columns are
    ignored; an empty table gives an empty result.
    """
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).select("doc_id", F.xxhash64("text").alias("text_print"), "text")
    anchors = saved(_anchor_rows(texts), "anchors")
    recurring = checkpointed(
        anchors.groupBy("phrase")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("doc_id", "text_print")).alias("owner"))
        .where("n > 1")
        .select("phrase", "owner")
    )
    n_shards = max(1, -(-recurring.count() // SHARD_PHRASES))
    of_text = (
        anchors.join(_sharded(recurring, n_shards), "phrase")
        .groupBy(F.col("doc_id").alias("of_id"), F.col("text_print").alias("of_print"))
        .agg(F.collect_set(F.struct("phrase", "shard")).alias("anchors"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_print") == F.col("of_print"))
    rows = _counted(texts.join(of_text, same, "left").select("doc_id", "text", "anchors"))
    candidates = rows.where("anchors IS NOT NULL")

    confirmed = (
        _candidate_windows(candidates)
        .groupBy("window", "check")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("check").bitwiseAND(0x7FFFFFFF).cast("int").alias("shard"), "window", F.lit(None).cast("string").alias("words"))
    )
    phrases = _phrase_texts(candidates).select("shard", F.lit(None).cast("bigint").alias("window"), "words")
    patterns = saved(confirmed.unionAll(phrases), "phrase-patterns")

    runs = _runs(candidates, patterns)
    of_row = saved(
        runs.groupBy("row_id").agg(F.collect_list(F.struct("begins", "ends")).alias("runs")), "covered-runs"
    )
    removed = _applied(
        candidates.join(of_row, "row_id", "left").select("doc_id", "n_words", "text", "runs")
    )
    untouched = rows.where("anchors IS NULL").select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256"
    )
    return untouched.unionAll(removed)
