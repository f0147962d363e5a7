"""A provider's answers are kept: nothing is asked twice, failures are asked again."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import values

from ticketloom.operators.answers import ask_once, known_answers
from ticketloom.operators.language import translate_content


def logging_provider(folder, fails="!"):
    """Writes down every text it is asked for, in a file per call; fails for texts that contain ``fails``."""
    place = str(folder)

    def answers(texts: pd.Series) -> pd.Series:
        import uuid
        from pathlib import Path

        Path(place, uuid.uuid4().hex).write_text("\n".join(texts))
        return texts.map(lambda t: None if fails in t else t.upper())

    return answers


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()

    def asked():
        found = sorted(line for f in folder.iterdir() for line in f.read_text().split("\n"))
        for f in folder.iterdir():
            f.unlink()
        return found

    return folder, asked


def test_nothing_is_asked_twice(spark, tmp_path, log):
    folder, asked = log
    store, provider = str(tmp_path / "store"), logging_provider(folder)
    rows = [(k, t) for k, t in enumerate(["a", "b", "a", None, "c!", "", "a", "b", "c!"] * 4)]
    df = spark.createDataFrame(rows, "id int, body string").repartition(8)
    first = ask_once(df, "body", "answer", store, provider)
    assert (first.n_new, first.n_answered) == (4, 3) and asked() == ["", "a", "b", "c!"]
    expected = [(k, t, None if t is None or "!" in t else t.upper()) for k, t in rows]
    assert sorted(map(tuple, first.rows.collect())) == sorted(expected)

    again = ask_once(df, "body", "answer", store, provider)
    assert (again.n_new, again.n_answered) == (1, 0) and asked() == ["c!"]
    mended = ask_once(df, "body", "answer", store, logging_provider(folder, fails="?"))
    assert (mended.n_new, mended.n_answered) == (1, 1) and asked() == ["c!"]
    assert ask_once(df, "body", "answer", store, provider).n_new == 0 and asked() == []
    more = spark.createDataFrame([(100, "d"), (101, "a")], df.schema)
    assert ask_once(df.union(more), "body", "answer", store, provider).n_new == 1 and asked() == ["d"]
    assert ask_once(df.limit(0), "body", "answer", store, provider).rows.count() == 0
    assert known_answers(spark, store).count() == 5


def test_a_job_that_fails_keeps_its_finished_waves(spark, tmp_path, log):
    folder, asked = log
    store = str(tmp_path / "store")
    df = spark.createDataFrame([(f"text {k}",) for k in range(60)], "body string")

    def short(texts: pd.Series) -> pd.Series:
        """Gives no answers at all in some wave, which stops the job."""
        return texts.iloc[:-1] if (texts == "text 17").any() else texts

    with pytest.raises(Exception, match="answers for"):
        ask_once(df, "body", "answer", store, short, texts_per_commit=10).rows.count()
    kept = {r["answer"] for r in known_answers(spark, store).collect()}
    found = ask_once(df, "body", "answer", store, logging_provider(folder), texts_per_commit=10)
    assert len(kept) + found.n_new == 60 and not kept & set(asked())
    assert found.rows.where("answer IS NULL").count() == 0


def test_answers_of_two_jobs(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([("a",)], "body string")
    ask_once(df, "body", "answer", store, lambda t: t + "2")
    known_answers(spark, store).selectExpr("digest", "'a1' AS answer").write.mode("append").parquet(store)
    assert values(ask_once(df, "body", "answer", store, lambda t: t).rows, "answer") == [("a1",)]


def test_translation_with_a_store(spark, tmp_path, log):
    folder, asked = log
    rows = [(1, "het is een dag"), (2, "het is een dag"), (3, "it is a day"), (4, "de dag is niet goed!"), (5, None)]
    df = spark.createDataFrame(rows, "id int, content string")
    for texts in (["de dag is niet goed!", "het is een dag"], ["de dag is niet goed!"]):
        done = translate_content(df, provider=logging_provider(folder), store=str(tmp_path / "store")).orderBy("id").collect()
        assert [(r["detected_language"], r["translated_content"]) for r in done] == [
            ("Dutch", "HET IS EEN DAG"), ("Dutch", "HET IS EEN DAG"), ("English", "it is a day"),
            ("error", "de dag is niet goed!"), ("unknown", ""),
        ]
        assert asked() == texts
