"""Packing of tokenized documents into sequences of bounded length by bin completion.

Lengths are packed as a multiset: the largest piece left is put in a new sequence and
the fillings around it are tried in order of the tokens they waste. A filling is
skipped if another one dominates it (a piece could be added, or one of its pieces
exchanged for a longer one, or two of them for one as long, and it still fits). The best-fit-decreasing
solution is the incumbent; a branch ends once its waste leaves no room for a better
one, and the search ends at the lower bound.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticketloom.llm.shared import saved

CAPACITY = 1024
END_ID = 2
GROUP = 1 << 15  # pieces packed together; each group may cost a part of one sequence
NODES = 10_000  # fillings looked at for one group before its incumbent is taken

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@cache
def _encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def _tokenizer(path: str) -> tuple[Tokenizer, tuple[str, ...]]:
    tokenizer = Tokenizer.from_file(path)
    added = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    return tokenizer, added


def token_ids(text: str | None, tokenizer_path: str, ranks_path: str, pattern: str) -> np.ndarray:
    """The ids of the tokenizer in ``tokenizer_path`` and the end id.

    ``ranks_path`` holds the same vocabulary for a faster encoder, which reads every
    text but those in which the tokenizer would find one of its special tokens.
    """
    text = text or ""
    tokenizer, added = _tokenizer(tokenizer_path)
    if any(token in text for token in added):
        ids = np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    else:
        ids = _encoder(ranks_path, pattern).encode_to_numpy(text, disallowed_special=())
    return np.append(ids, np.uint32(END_ID)).astype("<u4")


def cut(n: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: full ones, after a shorter first one if need be."""
    first = n % CAPACITY
    starts = ([0] if first else []) + list(range(first, n, CAPACITY))
    return [(s, (first if s == 0 and first else CAPACITY)) for s in starts]


def tokenized(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str,
    pattern: str,
    id_column: str,
    text_column: str,
    with_ids: bool,
) -> DataFrame:
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, contents = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(text.as_py(), tokenizer_path, ranks_path, pattern)
                for piece, (start, length) in enumerate(cut(len(ids))):
                    own = ids[start : start + length]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own.tobytes())))
                    if with_ids:
                        contents.append(own.astype(np.int32))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = [c.split()[0] for c in PIECES.split(", ")]
            if with_ids:
                arrays.append(pa.array(contents, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    texts = docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string"))
    return texts.mapInArrow(tokenize, PIECES + (", ids array<int>" if with_ids else ""))


def lower_bound(counts: np.ndarray) -> int:
    """No packing of ``counts[length]`` pieces has fewer sequences (Martello and Toth)."""
    lengths = np.arange(CAPACITY + 1)
    half = CAPACITY // 2
    pieces, tokens = np.cumsum(counts), np.cumsum(counts * lengths)
    least = np.arange(half + 1)
    alone = pieces[-1] - pieces[CAPACITY - least]
    large = pieces[CAPACITY - least] - pieces[half]
    room = large * CAPACITY - (tokens[CAPACITY - least] - tokens[half])
    small = tokens[half] - np.where(least > 0, tokens[np.maximum(least - 1, 0)], 0)
    extra = -(-np.maximum(0, small - room) // CAPACITY)
    return int((alone + large + extra).max())


def best_fit(counts: np.ndarray) -> list[list[int]]:
    """Each piece, longest first, into the fullest sequence that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(CAPACITY + 1)]
    has_room = np.zeros(CAPACITY + 1, bool)
    for length in np.flatnonzero(counts)[::-1].tolist():
        for _ in range(int(counts[length])):
            rooms = has_room[length:]
            at = int(rooms.argmax())
            if rooms[at]:
                room = length + at
                chosen = by_room[room].pop()
                has_room[room] = bool(by_room[room])
                bins[chosen].append(length)
            else:
                room, chosen = CAPACITY, len(bins)
                bins.append([length])
            by_room[room - length].append(chosen)
            has_room[room - length] = True
    return bins


def fillings(left: np.ndarray, room: int, nodes: list[int]) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room`` from ``left[length]`` pieces, least waste first.

    They are formed one by one as the search asks for them: which sums the pieces up to
    each length can reach is kept as bits, so every step leads to a filling. Each one
    that is looked at takes a node, and the last node ends it.
    """
    lengths = np.flatnonzero(left[: room + 1]).tolist()
    times = [int(left[x]) for x in lengths]
    inside = (1 << room + 1) - 1
    reach = [1]
    for length, n in zip(lengths, times, strict=True):
        sums = reach[-1]
        for _ in range(min(n, room // length)):
            sums |= sums << length & inside
        reach.append(sums)

    def exactly(total: int, kinds: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
            return
        while kinds and not reach[kinds] >> total & 1:
            kinds -= 1
        for kind in range(min(kinds, bisect_right(lengths, total)), 0, -1):
            if not reach[kind] >> total & 1:
                return
            length = lengths[kind - 1]
            for n in range(min(times[kind - 1], total // length), 0, -1):
                if reach[kind - 1] >> total - n * length & 1:
                    for rest in exactly(total - n * length, kind - 1):
                        yield (length,) * n + rest

    def dominated(chosen: tuple[int, ...], waste: int) -> bool:
        free = present
        for x in set(chosen):
            if left[x] <= chosen.count(x):
                free &= ~(1 << x)
        if free & (2 << waste) - 1:
            return True
        one = any(free >> x + 1 & (1 << waste) - 1 for x in set(chosen))
        two = {a + b for i, a in enumerate(chosen) for b in chosen[i + 1 :]}
        return one or any(free >> x & (2 << waste) - 1 for x in two)

    present = sum(1 << x for x in lengths)
    for waste in range(room + 1):
        if reach[-1] >> room - waste & 1:
            for chosen in exactly(room - waste, len(lengths)):
                nodes[0] -= 1
                if nodes[0] < 0:
                    return
                if not dominated(chosen, waste):
                    yield chosen


def complete_bins(counts: np.ndarray, nodes: int = NODES) -> list[list[int]]:
    """The lengths of each sequence, from ``nodes`` fillings looked at.

    Best fit fills most sequences without waste. The sequences that waste most, together
    at least a whole one, are packed anew by bin completion, along with as many of those
    that have the most pieces, whose short ones fill gaps. A set that could lose a
    sequence and did not is searched again with twice as many of both kinds.
    """
    best = best_fit(counts)
    bound = lower_bound(counts)
    left, more = [nodes], 1
    while len(best) > bound and left[0] > 0:
        best.sort(key=sum)
        wasted = np.cumsum([CAPACITY - sum(b) for b in best])
        n = min(len(best), more * (int(np.searchsorted(wasted, CAPACITY)) + 1))
        best[n:] = sorted(best[n:], key=len, reverse=True)
        chosen = best[: 2 * n]
        own = np.bincount([x for b in chosen for x in b], minlength=CAPACITY + 1)
        packed = search(own, left, chosen) if lower_bound(own) < len(chosen) else chosen
        if len(packed) < len(chosen):
            best, more = packed + best[2 * n :], 1
        elif len(chosen) == len(best):
            break
        else:
            more *= 2
    return best


def search(
    counts: np.ndarray, nodes: list[int] | None = None, incumbent: list[list[int]] | None = None
) -> list[list[int]]:
    """Branch and bound over the fillings around the largest piece left.

    It ends at the lower bound, when no branch is left, or when ``nodes``, which it
    counts down, are used up.
    """
    nodes = [NODES] if nodes is None else nodes
    counts = counts.astype(np.int64)
    best = best_fit(counts)
    if incumbent is not None and len(incumbent) <= len(best):
        best = incumbent
    bound = lower_bound(counts)
    total = int((counts * np.arange(CAPACITY + 1)).sum())
    left = counts.copy()
    path: list[tuple[int, tuple[int, ...], Iterator[tuple[int, ...]]]] = []
    wasted = [0]

    def place(largest: int, chosen: tuple[int, ...], sign: int) -> None:
        for length in (largest, *chosen):
            left[length] -= sign

    def options() -> tuple[int, Iterator[tuple[int, ...]]]:
        largest = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[largest] -= 1
        return largest, fillings(rest, CAPACITY - largest, nodes)

    if len(best) <= bound:
        return best
    largest, ways = options()
    while len(best) > bound:
        chosen = next(ways, None)
        waste = 0 if chosen is None else wasted[-1] + CAPACITY - largest - sum(chosen)
        if chosen is None or waste > (len(best) - 1) * CAPACITY - total:
            if not path or nodes[0] <= 0:  # what follows wastes at least as much
                break
            largest, undone, ways = path.pop()
            wasted.pop()
            place(largest, undone, -1)
            continue
        place(largest, chosen, 1)
        path.append((largest, chosen, ways))
        wasted.append(waste)
        if left.any():
            largest, ways = options()
        else:
            best = [[a, *b] for a, b, _ in path]
            largest, undone, ways = path.pop()
            wasted.pop()
            place(largest, undone, -1)
    return best


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(group_, place, length)`` rows of whole groups to their places."""
    rows = list(batches)
    if not rows:
        return
    group = np.concatenate([b.column(0).to_numpy() for b in rows])
    place = np.concatenate([b.column(1).to_numpy() for b in rows])
    length = np.concatenate([b.column(2).to_numpy() for b in rows])
    for g in np.unique(group):
        own = np.flatnonzero(group == g)
        own = own[np.lexsort((place[own], length[own]))]
        counts = np.bincount(length[own], minlength=CAPACITY + 1)
        following = np.cumsum(counts) - counts
        sequence, offset = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
        for number, lengths in enumerate(complete_bins(counts)):
            at = 0
            for piece in lengths:
                sequence[following[piece]], offset[following[piece]] = number, at
                following[piece] += 1
                at += piece
        yield pa.RecordBatch.from_arrays(
            [pa.array(place[own]), pa.array((int(g) << 32) + sequence), pa.array(offset)],
            ["place", "sequence_id", "offset"],
        )


def best_fit_packing(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    group: int = GROUP,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and its ids).

    A document is its token ids and the end id; one of more than 1,024 ids is cut into
    full pieces after a shorter first one. Full pieces are sequences of their own; the
    others are dealt evenly into groups of about ``group`` pieces, whatever their
    document, and each group is packed in one task. NULL or empty text is one piece of
    the end id; every row counts, also one that repeats an id or has none. Other
    columns are ignored; an empty table gives an empty result.
    """
    cut_up = tokenized(docs, tokenizer_path, ranks_path, pattern, id_column, text_column, with_ids)
    pieces = saved(cut_up.withColumn("place", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < CAPACITY)
    n_groups = max(1, -(-short.count() // group))
    dealt = short.select(
        F.pmod(F.xxhash64("place"), F.lit(n_groups)).alias("group_"), "place", "length"
    ).repartition(n_groups, "group_")
    packed = saved(dealt.mapInArrow(_pack, "place bigint, sequence_id bigint, offset bigint"), "packed")
    return pieces.join(packed, "place", "left").select(
        *[c for c in pieces.columns if c != "place"],
        F.coalesce("sequence_id", -F.col("place") - 1).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("bigint")).alias("offset"),
    )
