"""Language scoring, routing and translation as Columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Given the texts of a batch, answer one text or None (= failed) for each.
Provider = Callable[[pd.Series], pd.Series]

UNKNOWN = "unknown"
ERROR = "error"
SOURCE_LANGUAGE = "Dutch"
WORD_BREAK = r"[^\p{L}]+"

SKIP, TRANSLATE, KEEP = "skip", "translate", "keep"

# A map literal is searched from its start, so a glossary is split into maps of about so many words.
GLOSSARY_MAP = 16


def words(text: Column) -> Column:
    return F.split(F.lower(text), WORD_BREAK)


def word_array(values) -> Column:
    return F.array(*[F.lit(value) for value in sorted(set(values))])


def detected_language(text: Column, stop_words: Mapping[str, Sequence[str]]) -> Column:
    """The language with the most different stop words in the text, or 'unknown'.

    One expression that names ``text`` once: a filter on the result can be pushed below
    the projection without scoring the text several times. The text is split once and
    reduced to the listed words it contains; the one-element ``transform`` binds that
    short list, which every language's score then reads.
    """
    every_word = word_array(w for listed in stop_words.values() for w in listed)
    present = F.array_intersect(words(text), every_word)

    def candidate(score: Column, rank: int, name: str) -> Column:
        return F.struct(
            score.alias("score"), F.lit(rank).alias("rank"), F.lit(name).alias("name")
        )

    def best(found: Column) -> Column:
        # 'unknown' scores nothing and outranks languages that score nothing as well.
        candidates = [candidate(F.lit(0), 1, UNKNOWN)]
        for i, (name, listed) in enumerate(stop_words.items()):
            hits = F.size(F.array_intersect(found, word_array(listed)))
            candidates.append(candidate(hits, -i, name))
        return F.array_max(F.array(*candidates))

    return F.get(F.transform(F.array(present), best), 0)["name"]


def is_language(answer: Column, language: str) -> Column:
    """Exact, case-insensitive: an answer of 'Dutch.' is not 'Dutch'."""
    return F.coalesce(F.lower(answer) == language.lower(), F.lit(False))


def mentions_language(answer: Column, language: str) -> Column:
    """The looser test of the statistics: the answer contains the name."""
    return answer.ilike(f"%{language}%")


def route(answer: Column, blank: Column, source: str) -> Column:
    """What happens to a row: blank rows are skipped, the source language is translated."""
    return (
        F.when(blank, F.lit(SKIP))
        .when(is_language(answer, source), F.lit(TRANSLATE))
        .otherwise(F.lit(KEEP))
    )


def glossary_text(text: Column, glossary: Mapping[str, str]) -> Column:
    """Word-for-word substitution on space-separated words; unlisted words stay."""
    if not glossary:
        raise ValueError("a glossary has a word at least")
    n = -(-len(glossary) // GLOSSARY_MAP)
    maps: list[dict[str, str]] = [{} for _ in range(n)]
    for word, answer in glossary.items():
        maps[zlib.crc32(word.encode()) % n][word] = answer
    tables = F.array(
        *[
            F.create_map(*[F.lit(part) for pair in words.items() for part in pair]).cast("map<string,string>")
            for words in maps
        ]
    )

    def answered(word: Column) -> Column:
        table = tables[(F.crc32(F.lower(word).cast("binary")) % n).cast("int")]
        return F.coalesce(F.try_element_at(table, F.lower(word)), word)

    return F.array_join(F.transform(F.split(text, " "), answered), " ")


def ask_provider(text: Column, provider: Provider, batch_size: int | None = None) -> Column:
    """A provider's answers, batch by batch in the tasks; NULL texts are never sent.

    Texts that are equal within an Arrow batch are sent once, ``batch_size`` at a time
    (all of the Arrow batch by default, see ``spark.sql.execution.arrow.maxRecordsPerBatch``).
    If a call fails its texts are asked one by one, so only the failing ones become NULL.
    The column is marked non-deterministic so that the optimizer does not repeat the calls.
    """

    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def ask_one(value):
            try:
                return list(provider(pd.Series([value])))[0]
            except Exception:
                return None

        for batch in batches:
            texts = batch.dropna().drop_duplicates()
            size = batch_size or max(len(texts), 1)
            answers = {}
            for start in range(0, len(texts), size):
                sent = texts.iloc[start : start + size].reset_index(drop=True)
                try:
                    replies = list(provider(sent))
                except Exception:
                    replies = [ask_one(value) for value in sent]
                if len(replies) != len(sent):
                    raise ValueError(f"provider gave {len(replies)} answers for {len(sent)} texts")
                answers.update(
                    (value, reply.strip())
                    for value, reply in zip(sent, replies, strict=True)
                    if isinstance(reply, str)
                )
            yield pd.Series([answers.get(value) for value in batch], dtype=object)

    return F.pandas_udf(ask, "string").asNondeterministic()(text)
