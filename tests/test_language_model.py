"""The trained detector against a plain count of trigrams."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketloom.functions.grams import BUCKETS, trigram_buckets
from ticketloom.operators.language import detect_language, translate_content
from ticketloom.operators.language_model import PRIOR, UNSEEN, LanguageModel, train_language_model, trigram_counts

TEXTS = [
    ("de hond loopt naar het huis en de kat niet", "Dutch"),
    ("het is een mooie dag voor de klant", "Dutch"),
    ("the dog walks to the house and the cat does not", "English"),
    ("it is a fine day for the customer", "English"),
    ("der Hund geht nach Hause, die Katze nicht", "German"),
    ("", "German"),
    (None, "English"),
    ("no language", None),
    ("É🙂ü 12 ab𝒳c Ii", "Other"),
]


def plain_buckets(text):
    shown = [c if unicodedata.category(c).startswith("L") and ord(c) <= 0xFFFF else " " for c in (text or "").lower()]
    shown = [" ", *shown, " "]
    return [
        ((ord(a) * 31 + ord(b)) * 31 + ord(c)) % BUCKETS
        for a, b, c in zip(shown, shown[1:], shown[2:], strict=False)
        if b != " "
    ]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, *row) for k, row in enumerate(TEXTS * 3)]
    return spark.createDataFrame(rows, "id bigint, body string, said string").repartition(5)


def test_trigrams(monkeypatch):
    texts = [t for t, _ in TEXTS] + ["x", "  ", "long word " * 20_000]
    for block in (10, 1 << 20):
        monkeypatch.setattr("ticketloom.functions.grams._BLOCK_CHARS", block)
        found = [b[i:j].tolist() for b, at in trigram_buckets(pa.array(texts)) for i, j in zip(at, at[1:], strict=False)]
        assert found == [plain_buckets(t) for t in texts]


def test_counts_and_weights(labelled):
    counts: dict = {}
    for text, said in TEXTS * 3:
        if said is not None:
            counts.setdefault(said, Counter()).update(plain_buckets(text))
            counts[said][PRIOR] += 1
    expected = {(said, b): n for said, own in counts.items() for b, n in own.items()}
    assert {(r["language"], r["bucket"]): r["n"] for r in trigram_counts(labelled, "body", "said").collect()} == expected
    every = sum(own[PRIOR] for own in counts.values())
    for r in train_language_model(labelled, "body", "said").collect():
        own = counts[r["language"]]
        smoothed = sum(n for b, n in own.items() if b != PRIOR) + BUCKETS
        share = {UNSEEN: 1 / smoothed, PRIOR: own[PRIOR] / every}.get(r["bucket"], (own[r["bucket"]] + 1) / smoothed)
        assert r["weight"] == round(math.log(share) * 1e6)


def test_detection(spark, labelled):
    model = LanguageModel.of(train_language_model(labelled, "body", "said"), odds=20)
    asked = ["de kat loopt naar de klant", "the customer walks to the house", "die Katze geht nach Hause", "", None, "123", "x" * 300_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(asked)], "id int, content string")
    found = [r["detected_language"] for r in detect_language(df, model=model).orderBy("id").collect()]
    assert found[:6] == ["Dutch", "English", "German", "unknown", "unknown", "unknown"]
    cautious = LanguageModel.of(train_language_model(labelled, "body", "said"), odds=1e30)
    assert [r["detected_language"] for r in detect_language(df, model=cautious).where("id = 0").collect()] == ["unknown"]
    done = translate_content(df, source="German", glossary={"katze": "cat"}, model=model).orderBy("id").collect()
    assert done[2]["translated_content"] == "die cat geht nach Hause" and done[0]["translated_content"] == asked[0]
    assert done[3]["translated_content"] == done[4]["translated_content"] == ""


def test_models_of_one_language_and_none(spark, labelled):
    one = LanguageModel.of(train_language_model(labelled.where("said = 'Dutch'"), "body", "said"))
    none = LanguageModel.of(train_language_model(labelled.limit(0), "body", "said"))
    texts = pa.array(["any text", "", None])
    assert one.answers(texts).to_pylist() == ["Dutch", "unknown", "unknown"]
    assert none.answers(texts).to_pylist() == ["unknown"] * 3
    assert none.scores(texts)[0].shape == (3, 0) and np.array_equal(one.scores(texts)[1], [7, 0, 0])


def test_large_columns_are_taken_a_block_at_a_time(monkeypatch):
    """No step on the way to the trigrams holds a whole batch of texts."""
    import pyarrow.compute as pc

    held = []
    lower = pc.utf8_lower
    monkeypatch.setattr(pc, "utf8_lower", lambda texts: held.append(len("".join(texts.to_pylist()))) or lower(texts))
    texts = ["Ein Satz mit Wörtern " * 100, None, ""] * 1000
    found = [n for _, at in trigram_buckets(pa.array(texts)) for n in np.diff(at)]
    assert len(found) == len(texts) and found[1::3] == found[2::3] == [0] * 1000 and len(set(found[::3])) == 1
    assert max(held) <= 1 << 18


def test_detector_runs_without_pandas(spark):
    model = LanguageModel.of(train_language_model(spark.createDataFrame([("ein satz", "de"), ("a phrase", "en")], "text string, lang string")))
    found = spark.createDataFrame([("ein satz ein satz ein satz",), (None,)], "text string").select(model.detect(F.col("text")).alias("x"))
    assert [r["x"] for r in found.collect()] == ["de", "unknown"]
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
