"""Phrase tables against a plain search."""

from __future__ import annotations

import random
import re
import uuid

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from ticketloom.operators.language import translate_content
from ticketloom import session
from ticketloom.operators import phrases as ops
from ticketloom.operators.phrases import phrase_matches, phrase_trie, substitute_phrases, substituted

PHRASES = [
    ("goede morgen", "good morning"), ("goede", "good"), ("Morgen", "tomorrow"), ("de hele dag", "all day"),
    ("hele", "whole"), ("goede morgen de dag", "never mind"), ("dag", "day"), ("dag", "afternoon"), ("één", "one"),
    (None, "x"), ("", "y"), ("12", "z"), ("niet", None), ("op-zicht", "in view"),
]


def plain(text, table):
    if text is None:
        return None
    entries: dict = {}
    for phrase, answer in table:
        words = tuple(re.findall(r"[^\W\d_]+", (phrase or "").lower()))
        if words and answer is not None:
            entries[words] = min(answer, entries.get(words, answer))
    tokens = re.findall(r"[^\W\d_]+|[\W\d_]+", text)
    out, k = [], 0
    while k < len(tokens):
        best = None
        if tokens[k][0].isalpha():
            words, j = [tokens[k].lower()], k
            while True:
                if tuple(words) in entries:
                    best = (j + 1, entries[tuple(words)])
                if len(words) == 4 or j + 2 >= len(tokens) or not re.fullmatch(r"[ \t\n\x0b\f\r]+", tokens[j + 1]):
                    break
                j += 2
                words.append(tokens[j].lower())
        out.append(best[1] if best else tokens[k])
        k = best[0] if best else k + 1
    return "".join(out)


@pytest.fixture(scope="module")
def phrases(spark):
    return spark.createDataFrame(PHRASES, "phrase string, answer string")


def test_longest_phrase_at_the_leftmost_place(spark, phrases):
    rng = random.Random(3)
    words = "goede Morgen de hele dag niet één op zicht anders".split()
    texts = [None, "", " ", "?!", "dag", "Goede  morgen,\tde hele\ndag!", "goede-morgen", "goede morgen de dag", "12 dag12"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", " ", "  ", ", ", "\n"]) for _ in range(rng.randint(1, 40))) for _ in range(80)]
    texts += ["dag anders " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string").withColumn("pos", F.lit(1)).withColumn("answer", F.lit(2))
    found = substitute_phrases(df, "body", phrases, "said")
    assert found.columns == ["id", "body", "pos", "answer", "said"]
    for r in found.collect():
        assert r["said"] == plain(texts[r["id"]], PHRASES), texts[r["id"]]
    assert substitute_phrases(df.limit(0), "body", phrases, "said").count() == 0
    assert values(substitute_phrases(df, "body", phrases.limit(0), "said").where("id < 9"), "said") == values(df.where("id < 9"), "body")


def test_texts_substituted_in_turns(spark, phrases, monkeypatch, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("goede Morgen de hele dag niet één op zicht".split(), k=rng.randint(1, 20))) for _ in range(40)]
    texts += [None, "", "dag"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    for module in (session, ops):
        monkeypatch.setattr(module, "shared_path", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    monkeypatch.setattr(ops, "CHARACTERS", 100)
    found = substitute_phrases(df, "body", phrases, "said")
    assert values(found, "id", "body", "said") == sorted(((i, x, plain(x, PHRASES)) for i, x in enumerate(texts)), key=repr)
    written = {p.relative_to(tmp_path).parts[0].rpartition("-")[0] for p in tmp_path.rglob("part-*.parquet")}
    assert written == {"phrase-trie", "substituted"}  # the texts' copy is gone


def test_trie_has_every_prefix_once(phrases):
    rows = {r["prefix"]: (r["depth"], r["answer"], r["longer"]) for r in phrase_trie(phrases).collect()}
    assert rows["goede"] == (1, "good", True) and rows["goede morgen"] == (2, "good morning", True)
    assert rows["goede morgen de"] == (3, None, True) and rows["dag"] == (1, "afternoon", False)
    assert rows["op zicht"] == (2, "in view", False) and len(rows) == 13


def test_places_that_overlap():
    words, gaps = list("abcd"), ["", " ", " ", " ", "."]
    assert substituted(words, gaps, [(0, 2, "X"), (1, 3, "Y"), (2, 1, "Z"), (2, 2, "W")]) == "X W."
    assert substituted(words, gaps, []) == "a b c d."


def test_a_large_table_is_not_in_the_plan(spark):
    table = spark.range(200_000).select(
        F.translate(F.hex("id"), "0123456789", "ghijklmnop").alias("word"), F.col("id").cast("string").alias("answer")
    )
    table = table.select(F.concat("word", F.lit(" x")).alias("phrase"), "answer")
    texts = spark.createDataFrame([(0, "IP X, ip x y FF x")], "id int, body string")
    found = substitute_phrases(texts, "body", table, "said")
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 50_000
    assert found.first()["said"] == f"{0x29}, {0x29} y {0xFF}"


def test_places_are_neither_written_nor_shuffled_one_by_one(spark, phrases, monkeypatch, tmp_path):
    texts = spark.createDataFrame([(0, "dag anders " * 20_000), (1, "goede anders " * 20_000), (2, None)], "id int, body string")
    monkeypatch.setattr(session, "shared_path", lambda _, name: f"{tmp_path}/{name}")
    found = phrase_matches(texts, phrase_trie(phrases), "id", "body", 4)
    assert values(found.groupBy("id", "n_words", "answer").count()) == [(0, 1, "afternoon", 20_000), (1, 1, "good", 20_000)]
    assert not list(tmp_path.rglob("*.parquet"))


def test_blocks_and_a_full_filter_change_nothing(spark, phrases, monkeypatch):
    texts = ["goede morgen de dag", "", "de hele dag goede morgen", None, "?", "hele, goede", "niet één"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string").coalesce(1)
    expected = values(phrase_matches(df, phrase_trie(phrases), "id", "body", 4))
    assert (0, 0, 4, "never mind") in expected and len(expected) == 42
    # All bits set: every place is a candidate, and the join alone decides. The blocks hold a text each.
    monkeypatch.setattr(ops, "_prefix_filter", lambda trie: np.full(16, -1, np.int64).view(np.uint64))
    monkeypatch.setattr(ops, "_BLOCK_WORDS", 1)
    assert values(phrase_matches(df, phrase_trie(phrases), "id", "body", 4)) == expected


def test_translation_by_a_phrase_table(spark, phrases):
    df = spark.createDataFrame([(1, "het is niet de hele dag"), (2, "it is the whole day"), (3, " ")], "id int, content string")
    found = translate_content(df, source="Dutch", phrases=phrases).orderBy("id").collect()
    assert [r["translated_content"] for r in found] == ["het is niet all day", "it is the whole day", ""]
    assert [r["detected_language"] for r in found] == ["Dutch", "English", "unknown"]
