"""Secret scans: fixed patterns, and formats learned from what they find.

The values the patterns find are labelled credentials. A prefix tree of each kind's
values is folded into a probabilistic automaton by merging states whose continuations
are statistically compatible (Hoeffding's bound). Every other token from the least labelled
length on is scored by its likelihood under the automata against that under ordinary
tokens, which no candidate trains.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.shared import saved
from ticketloom.llm.wordhash import blocks, mixed, run_hashes, text_bytes

# The patterns and the least lengths of their matches.
KINDS = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

LEARNED = "format"
TOKEN_LENGTH = 16
TRAINING_VALUES = 500  # of each kind, those with the smallest hashes
TRAINING_LENGTH = 128
ALPHA = 0.05
THRESHOLD = 0.5  # natural logarithm of the likelihood ratio, a symbol
EVIDENCE = THRESHOLD * (TOKEN_LENGTH + 2)  # and of the whole token, so that a short one needs more a symbol
CACHED_WORDS = 500_000  # of a task

_TOKEN_BYTES = np.zeros(256, bool)
_TOKEN_BYTES[[ord(c) for c in "+/_.=-"]] = True
for _low, _high in ("09", "AZ", "az"):
    _TOKEN_BYTES[ord(_low) : ord(_high) + 1] = True

def symbols(token: str) -> str:
    """Digits as 0, hexadecimal letters as a or A, other letters as z or Z, other characters as they are."""
    return token.translate(_CLASSES)


_CLASSES = {ord(c): "0" for c in "123456789"}
_CLASSES |= {ord("a") + i: "a" if i < 6 else "z" for i in range(26)}
_CLASSES |= {ord("A") + i: "A" if i < 6 else "Z" for i in range(26)}
_CLASS_BYTES = np.arange(256, dtype=np.uint8)
for _character, _symbol in _CLASSES.items():
    _CLASS_BYTES[_character] = ord(_symbol)
_SPREAD = mixed(np.arange(256, dtype=np.uint64), 1)
PLAIN = re.compile(r"[AZ]?[az]+|0+")


def token_runs(data: np.ndarray, bounds: np.ndarray, least: int = TOKEN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of ``least`` or more token bytes, not across rows."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _TOKEN_BYTES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = np.flatnonzero(inside & (edge | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero((edge | ~inside) & np.concatenate([[False], inside[:-1]]))
    long = ends - begins >= least
    return begins[long], ends[long]


def assigned(text: str) -> Iterator[tuple[int, int, int, str]]:
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_VALUE:
                yield 0, m.start(), m.end(), m[2]


def inside_token(token: str, begin: int) -> Iterator[tuple[int, int, int, str]]:
    """Access keys and hexadecimal runs; their characters are token characters, so a match lies in one token."""
    for kind, pattern, least in ((1, ACCESS, ACCESS_LENGTH), (2, HEX, HEX_LENGTH)):
        if kind == 1 and "AKIA" not in token:
            continue
        for m in pattern.finditer(token):
            if m.end() - m.start() >= least:
                yield kind, begin + m.start(), begin + m.end(), m[0]


@dataclass
class Scan:
    """Rows ``low`` to ``high``: the pattern spans of each, in code points and in order, and the
    tokens that overlap none, as bytes ``begins[t]:ends[t]`` and by number of their class word."""

    low: int
    high: int
    spans: list[list[tuple[int, int, int, str]]]
    data: np.ndarray
    bounds: np.ndarray
    place: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    def class_words(self) -> tuple[list[str], np.ndarray]:
        """The distinct class words of the tokens, and the number of each token's."""
        classes = _CLASS_BYTES[self.data]
        key = run_hashes(_SPREAD[classes], self.begins, self.ends)
        first, of = np.unique(key, return_index=True, return_inverse=True)[1:]
        return [classes[self.begins[t] : self.ends[t]].tobytes().decode() for t in first], of


def pattern_spans(data: np.ndarray, bounds: np.ndarray, place: np.ndarray) -> Iterator[list]:
    """Of each row the pattern spans, in order."""
    begins, ends = token_runs(data, bounds)
    first = np.searchsorted(begins, bounds)
    for r in range(len(bounds) - 1):
        found = list(assigned(data[bounds[r] : bounds[r + 1]].tobytes().decode()))
        for b, e in zip(begins[first[r] : first[r + 1]], ends[first[r] : first[r + 1]], strict=True):
            found += inside_token(data[b:e].tobytes().decode(), int(place[b] - place[bounds[r]]))
        found.sort(key=lambda s: (s[1], s[0]))
        yield found


def scans(column: pa.Array) -> Iterator[Scan]:
    all_data, all_bounds = text_bytes(column)
    for low, high in blocks(all_bounds):
        bounds = all_bounds[low : high + 1] - all_bounds[low]
        data = all_data[all_bounds[low] : all_bounds[high]]
        place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        spans = list(pattern_spans(data, bounds, place))
        covered = np.zeros(place[-1] + 1, bool)
        for r, found in enumerate(spans):
            for _, begin, end, _ in found:
                covered[place[bounds[r]] + begin : place[bounds[r]] + end] = True
        total = np.concatenate([[0], np.cumsum(covered)])
        begins, ends = token_runs(data, bounds, 1)
        free = total[place[ends]] == total[place[begins]]
        yield Scan(low, high, spans, data, bounds, place, begins[free], ends[free])


def labelled(docs: DataFrame, text_column: str) -> DataFrame:
    """``(kind, value)`` of what the patterns find."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            for low, high in blocks(bounds):
                at = bounds[low : high + 1] - bounds[low]
                block = data[bounds[low] : bounds[high]]
                place = np.concatenate([[0], np.cumsum((block & 0xC0) != 0x80)])
                found = [s for spans in pattern_spans(block, at, place) for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s[0] for s in found], pa.int32()), pa.array([s[3] for s in found], pa.string())],
                    ["kind", "value"],
                )

    return docs.select(F.col(text_column).cast("string")).mapInArrow(find, "kind int, value string")


@dataclass
class State:
    arrived: int = 0
    ended: int = 0
    next: dict[str, int] = field(default_factory=dict)
    times: dict[str, int] = field(default_factory=dict)


@dataclass
class Automaton:
    """A probabilistic automaton; state 0 is its start."""

    states: list[State]

    @classmethod
    def prefix_tree(cls, words: Iterable[str]) -> Automaton:
        states = [State()]
        for word in words:
            at = 0
            states[at].arrived += 1
            for symbol in word:
                if symbol not in states[at].next:
                    states[at].next[symbol] = len(states)
                    states.append(State())
                states[at].times[symbol] = states[at].times.get(symbol, 0) + 1
                at = states[at].next[symbol]
                states[at].arrived += 1
            states[at].ended += 1
        return cls(states)

    def _like(self, a: int, b: int) -> bool:
        """Whether the continuations of two states differ no more than chance allows."""
        pairs = [(a, b)]
        while pairs:
            one, other = (self.states[x] for x in pairs.pop())
            if not one.arrived or not other.arrived:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (one.arrived**-0.5 + other.arrived**-0.5)
            if abs(one.ended / one.arrived - other.ended / other.arrived) > bound:
                return False
            for symbol in {*one.times, *other.times}:
                shares = [s.times.get(symbol, 0) / s.arrived for s in (one, other)]
                if abs(shares[0] - shares[1]) > bound:
                    return False
                if symbol in one.next and symbol in other.next:
                    pairs.append((one.next[symbol], other.next[symbol]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the counts of a subtree to the states its words reach from ``into``."""
        pairs = [(into, tree)]
        while pairs:
            kept, gone = pairs.pop()
            one, other = self.states[kept], self.states[gone]
            one.arrived += other.arrived
            one.ended += other.ended
            for symbol, target in other.next.items():
                one.times[symbol] = one.times.get(symbol, 0) + other.times[symbol]
                if symbol in one.next:
                    pairs.append((one.next[symbol], target))
                else:
                    one.next[symbol] = target

    def merged(self) -> Automaton:
        """Merge each state on the fringe with the first settled state it is like, or settle it."""
        settled = [0]
        while True:
            fringe = [
                (source, symbol, target)
                for source in settled
                for symbol, target in sorted(self.states[source].next.items())
                if target not in settled
            ]
            if not fringe:
                return self
            source, symbol, target = max(fringe, key=lambda f: (self.states[f[2]].arrived, -f[0], f[1]))
            like = next((s for s in settled if self._like(s, target)), None)
            if like is None:
                settled.append(target)
            else:
                self.states[source].next[symbol] = like
                self._fold(like, target)

    def log_likelihood(self, word: str) -> float:
        at, total = self.states[0], 0.0
        for symbol in word:
            if symbol not in at.next:
                return -math.inf
            total += math.log(at.times[symbol] / at.arrived)
            at = self.states[at.next[symbol]]
        return total + math.log(at.ended / at.arrived) if at.ended else -math.inf


def learned_automata(values: DataFrame) -> list[Automaton]:
    """One per kind, from a bounded sample of distinct values: TRAINING_VALUES of at most TRAINING_LENGTH characters."""
    automata = []
    for kind in range(len(KINDS)):
        chosen = (
            values.where((F.col("kind") == kind) & (F.length("value") <= TRAINING_LENGTH))
            .select("value")
            .distinct()
            .orderBy(F.xxhash64("value"), "value")
            .limit(TRAINING_VALUES)
            .collect()
        )
        if chosen:
            automata.append(Automaton.prefix_tree(symbols(r["value"]) for r in chosen).merged())
    return automata


def is_ordinary(word: str, automata: list[Automaton]) -> bool:
    """Whether tokens of a class word train the ordinary model: those too short to be scored, a
    plain word or number, and what no automaton accepts. So a credential of a learned format
    that mixes classes never does, however many there are."""
    return (
        len(word) < ASSIGN_VALUE
        or PLAIN.fullmatch(word) is not None
        or all(a.log_likelihood(word) == -math.inf for a in automata)
    )


class Cached(dict):
    """A function's values by class word; few words have many tokens."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, word: str):
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = self.function(word)
        return value


def ordinary_tokens(docs: DataFrame, text_column: str, automata: list[Automaton]) -> dict[str, float]:
    """Log probabilities of a symbol after another (``^`` begins, ``$`` ends), counted over ordinary tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(automata)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = sent.value
        ordinary = Cached(lambda word: is_ordinary(word, automata))
        times: dict[str, int] = {}
        for batch in batches:
            for scan in scans(batch.column(0)):
                words, of = scan.class_words()
                for word, n in zip(words, np.bincount(of, minlength=len(words)).tolist(), strict=True):
                    if ordinary[word]:
                        framed = f"^{word}$"
                        for i in range(len(framed) - 1):
                            step = framed[i : i + 2]
                            times[step] = times.get(step, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(times), pa.string()), pa.array(list(times.values()), pa.int64())], ["step", "n"]
        )

    counts = (
        docs.select(F.col(text_column).cast("string"))
        .mapInArrow(count, "step string, n bigint")
        .groupBy("step")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most 13 * 13 rows
    )
    alphabet = "0azAZ+/_.=-$"
    times = {a + b: 1 for a in "^" + alphabet for b in alphabet}
    for row in counts:
        times[row["step"]] += row["n"]
    totals = {a: sum(times[a + b] for b in alphabet) for a in "^" + alphabet}
    return {step: math.log(n / totals[step[0]]) for step, n in times.items()}


def format_score(token: str, automata: list[Automaton], ordinary: dict[str, float]) -> float:
    """The best log likelihood ratio a symbol; both sides draw a class's characters evenly."""
    word = symbols(token)
    framed = f"^{word}$"
    base = sum(ordinary[framed[i : i + 2]] for i in range(len(framed) - 1))
    best = max((a.log_likelihood(word) for a in automata), default=-math.inf)
    return (best - base) / len(framed)


def is_credential(word: str, automata: list[Automaton], ordinary: dict[str, float]) -> bool:
    score = format_score(word, automata, ordinary)
    return score >= THRESHOLD and score * (len(word) + 2) >= EVIDENCE


def secret_spans(docs: DataFrame, carried: list[str] | None = None, text_column: str = "text") -> DataFrame:
    """``row`` (the carried columns, all by default), ``n_assign``, ``n_access``, ``n_hex``,
    ``base_sha256``, ``n_format`` and ``spans`` for every row.

    Spans are ``kind:begin:end`` in code points, end exclusive, ordered by begin and
    kind. Pattern matches stay as they are; a learned span is a maximal run of 6 or
    more token characters that overlaps none of them and scores ``THRESHOLD`` a symbol
    and ``EVIDENCE`` as a whole, or more. Without any match nothing is learned and no
    span added. A NULL text is empty; repeated rows are scanned alike; other columns
    stay inside ``row``.
    """
    carried = list(docs.columns if carried is None else carried)
    automata = learned_automata(saved(labelled(docs, text_column), "labelled-secrets"))
    ordinary = ordinary_tokens(docs, text_column, automata) if automata else {}
    model = docs.sparkSession.sparkContext.broadcast((automata, ordinary))
    used = list(dict.fromkeys([*carried, text_column]))
    row_type = docs.select(*carried).schema.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata, ordinary = model.value
        credential = Cached(lambda word: is_credential(word, automata, ordinary))
        for batch in batches:
            rows = batch.column(0)
            counts: list[list[int]] = [[], [], [], []]
            digests, all_spans = [], []
            for scan in scans(rows.field(rows.type.get_field_index(text_column)).cast(pa.string())):
                extras: list[list] = [[] for _ in scan.spans]
                if automata:
                    words, of = scan.class_words()
                    hit = np.array([len(w) >= ASSIGN_VALUE and credential[w] for w in words], bool)
                    found = np.flatnonzero(hit[of]) if len(of) else of
                    row_of = np.searchsorted(scan.bounds, scan.begins[found], side="right") - 1
                    for r, t in zip(row_of.tolist(), found.tolist(), strict=True):
                        at = scan.place[scan.bounds[r]]
                        extras[r].append(
                            (int(scan.place[scan.begins[t]] - at), len(KINDS), int(scan.place[scan.ends[t]] - at))
                        )
                for spans, extra in zip(scan.spans, extras, strict=True):
                    base = [(s[1], s[0], s[2]) for s in spans]
                    for kind in range(len(KINDS) + 1):
                        counts[kind].append(sum(s[1] == kind for s in base + extra))
                    texts = [
                        ",".join(f"{(*KINDS, LEARNED)[k]}:{b}:{e}" for b, k, e in sorted(chosen))
                        for chosen in (base, base + extra)
                    ]
                    digests.append(hashlib.sha256(texts[0].encode()).hexdigest())
                    all_spans.append(texts[1])
            kept = pa.StructArray.from_arrays([rows.field(rows.type.get_field_index(c)) for c in carried], carried)
            yield pa.RecordBatch.from_arrays(
                [
                    kept,
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(digests, pa.string()),
                    pa.array(all_spans, pa.string()),
                ],
                ["row", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"],
            )

    return docs.select(F.struct(*used).alias("row")).mapInArrow(
        score,
        f"row {row_type}, n_assign bigint, n_access bigint, n_hex bigint, n_format bigint, "
        "base_sha256 string, spans string",
    )
