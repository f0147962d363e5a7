from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import values
from ticketloom.functions import language as lang
from ticketloom.functions.vocabulary import GLOSSARIES, STOP_WORDS
from ticketloom.operators import language as ops

DUTCH = "Ik heb een vraag over de klant en het alarm werkt niet"
ENGLISH = "I have a question about the customer and this does not work"
GERMAN = "Ich habe eine Frage und das ist nicht für die Kunden"


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string")


def outcome(df):
    rows = df.orderBy("id").collect()
    return [(r.detected_language, r.translated_content) for r in rows]


def test_detects_each_language(spark):
    texts = [" ".join(words[:12]) for words in STOP_WORDS.values()]
    out = ops.detect_language(frame(spark, *texts, "xyzzy", "", None)).orderBy("id").collect()
    assert [r.detected_language for r in out] == [*STOP_WORDS, "unknown", "unknown", "unknown"]


def test_detection_reads_the_whole_text(spark):
    late = "xyzzy " * 5000 + DUTCH
    assert ops.detect_language(frame(spark, late)).first().detected_language == "Dutch"


def test_ties_go_to_the_language_listed_first(spark):
    both = {"One": ["a", "b"], "Two": ["b", "a"]}
    assert ops.detect_language(frame(spark, "b a"), stop_words=both).first().detected_language == "One"


def test_only_the_source_language_is_translated(spark):
    out = outcome(ops.translate_content(frame(spark, DUTCH, ENGLISH, "  ", None, GERMAN)))
    assert out == [
        ("Dutch", "I have a question over the customer and the alarm works not"),
        ("English", ENGLISH),
        ("unknown", ""),
        ("unknown", ""),
        ("German", GERMAN),
    ]


def test_kept_content_is_whole_and_can_be_cut(spark):
    long = "x" * 1001
    assert outcome(ops.translate_content(frame(spark, long))) == [("unknown", long)]
    cut = ops.translate_content(frame(spark, long), max_chars=1000)
    assert outcome(cut) == [("unknown", "x" * 1000 + "...")]


def test_rows_are_never_dropped(spark):
    df = frame(spark, DUTCH, "", None, "xyzzy", ENGLISH)
    assert ops.translate_content(df).count() == df.count()


def test_provider_gets_only_the_routed_rows(spark):
    def shout(texts: pd.Series) -> pd.Series:
        if not texts.str.contains("vraag").all():
            raise AssertionError("unexpected text")
        return "  " + texts.str.upper() + "\n"

    out = outcome(ops.translate_content(frame(spark, DUTCH, ENGLISH, None), provider=shout))
    assert out == [("Dutch", DUTCH.upper()), ("English", ENGLISH), ("unknown", "")]


def test_failed_texts_become_errors_one_by_one(spark):
    def picky(texts: pd.Series) -> pd.Series:
        if texts.str.contains("boom").any():
            raise RuntimeError("model unavailable")
        return texts.map(lambda t: None if "null" in t else "ok")

    texts = [DUTCH, DUTCH + " boom", DUTCH + " null"]
    out = outcome(ops.translate_content(frame(spark, *texts).coalesce(1), provider=picky))
    assert out == [("Dutch", "ok"), ("error", texts[1]), ("error", texts[2])]


def test_provider_must_answer_every_text(spark):
    two = frame(spark, DUTCH, DUTCH + " nog").coalesce(1)
    df = ops.translate_content(two, provider=lambda t: t[:1])
    with pytest.raises(Exception, match="1 answers for 2 texts"):
        df.collect()


def test_equal_texts_are_sent_once_in_batches_of_the_given_size(spark):
    def sizes(texts: pd.Series) -> pd.Series:
        return pd.Series([f"one of {len(texts)}"] * len(texts))

    texts = [f"{DUTCH} {'nog ' * (i % 5)}" for i in range(20)]
    df = ops.translate_content(frame(spark, *texts, None).coalesce(1), provider=sizes, batch_size=3)
    answers = [answer for _, answer in outcome(df)]
    assert answers == ["one of 3" if i % 5 < 3 else "one of 2" for i in range(20)] + [""]


def test_detector_answers_are_stripped_and_failures_are_errors(spark):
    def detector(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if "fail" in t else " Dutch\n" if "vraag" in t else "Dutch.")

    out = outcome(
        ops.translate_content(frame(spark, DUTCH, "fail", " ", "iets"), detector=detector)
    )
    assert out[0][0] == "Dutch" and out[0][1] != DUTCH
    assert out[1:] == [("error", "fail"), ("unknown", ""), ("Dutch.", "iets")]


def test_equality_routes_but_containment_counts(spark):
    df = spark.createDataFrame([("Dutch",), ("DUTCH",), ("Dutch.",), ("German",), (None,)], "a string")
    out = df.select(
        lang.is_language(F.col("a"), "Dutch").alias("equal"),
        F.coalesce(lang.mentions_language(F.col("a"), "Dutch"), F.lit(False)).alias("named"),
    )
    assert [tuple(r) for r in out.collect()] == [
        (True, True),
        (True, True),
        (False, True),
        (False, False),
        (False, False),
    ]
    counted = ops.language_mentions(df.withColumnRenamed("a", "detected_language"))
    assert values(counted) == [(3,)]


def test_language_counts_are_ordered(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "detected_language string")
    assert [tuple(r) for r in ops.language_counts(df).collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_glossaries_of_any_size(spark):
    large = {f"w{i}": f"a{i}" for i in range(2000)}
    df = spark.createDataFrame([("W7 x w1999  w2000 W0",), (None,)], "t string")
    assert values(df.select(lang.glossary_text(F.col("t"), large))) == [("a7 x a1999  w2000 a0",), (None,)]
    with pytest.raises(ValueError, match="glossary"):
        lang.glossary_text(F.lit("x"), {})


def test_filter_on_the_language_scores_each_text_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("text", "content")
    plan = ops.glossary_translate(docs, source="German")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"split(lower(") == 1
