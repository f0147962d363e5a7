from __future__ import annotations

import datetime as dt
import json

import pytest

from conftest import values
from ticketloom import schemas
from ticketloom.__main__ import main
from ticketloom.sinks.csv_files import write_csv
from ticketloom.sources.csv_files import read_csv


@pytest.fixture
def landing_area(tmp_path):
    def land(name, *responses):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text("\n".join(json.dumps(r) for r in responses))
        return str(tmp_path / name)

    def ticket(i, subject):
        return {"id": i, "properties": {"subject": subject}}

    def email(i, subject, text):
        return {"id": i, "properties": {"hs_email_subject": subject, "hs_email_text": text}}

    return {
        "tickets": land("pages", {"results": [ticket("1", "A"), ticket("2", "B"), ticket("3", "C")]}),
        "associations": land(
            "reads",
            {"ticket_id": "1", "results": [{"id": "x"}, {"id": "y"}]},
            {"ticket_id": "2", "results": [{"id": "y"}]},
            {"ticket_id": "3", "results": []},
        ),
        "emails": land(
            "emails", email("x", "A", "Ik heb een <b>vraag</b>"), email("y", "Z", "This is the\nmail")
        ),
    }


def options(**values_):
    return [part for key, value in values_.items() for part in (f"--{key}", str(value))]


def test_landed_jobs(spark, landing_area, tmp_path, capsys):
    where = {k: landing_area[k] for k in ("tickets", "associations")}
    main(["merge-associations", *options(**where, output=tmp_path / "merged")])
    out = capsys.readouterr().out
    path = out.splitlines()[0]
    merged = spark.read.csv(path, header=True)
    assert values(merged, "id", "association_id") == [("1", "x"), ("1", "y"), ("2", "y"), ("3", None)]
    assert "33.33" in out

    main(["compare-subjects", *options(**landing_area)])
    assert "50.0" in capsys.readouterr().out

    main(["expand-emails", *options(**landing_area, output=tmp_path / "expanded")])
    expanded = read_csv(spark, str(tmp_path / "expanded"), schemas.TICKET_EMAIL)
    assert values(expanded, "ticket_id", "association_id") == [("1", "x"), ("1", "y"), ("2", "y")]

    files = options(input=tmp_path / "expanded", output=tmp_path / "translated")
    main(["translate-emails", *files])
    assert "I have a question" in capsys.readouterr().out


def test_warehouse_jobs(spark, tmp_path, capsys):
    day = dt.datetime(2024, 5, 31)
    mart = spark.createDataFrame([("1", day, "s", "Support", "EMAIL")], schemas.TICKET_MART)
    mart.write.parquet(str(tmp_path / "mart"))
    raw = spark.createDataFrame(
        [("1", "s", "body", day, "d", "o", "p", "g")], schemas.TICKET_RAW
    )
    raw.write.parquet(str(tmp_path / "raw"))
    window = ["--as-of", "2024-06-01"]
    where = options(mart=tmp_path / "mart", raw=tmp_path / "raw", output=tmp_path / "extract")
    main(["extract-tickets", *where, *window])
    found = read_csv(spark, str(tmp_path / "extract"), schemas.SUPPORT_TICKET)
    assert values(found) == [("1", day, "s", "body")]
    main(["dump-tickets", *options(raw=tmp_path / "raw", output=tmp_path), *window])
    assert "property_hs_pipeline_stage" in capsys.readouterr().out


def test_translation_with_a_trained_detector_and_phrases(spark, tmp_path, capsys):
    texts = [("een vraag over de factuur van gisteren", "Dutch"), ("a question about the invoice of yesterday", "English")]
    spark.createDataFrame(texts * 20, "text string, lang string").write.parquet(str(tmp_path / "texts"))
    main(["train-languages", *options(texts=tmp_path / "texts", output=tmp_path / "model")])
    spark.createDataFrame([("een vraag", "one question")], "phrase string, answer string").write.parquet(str(tmp_path / "phrases"))
    emails = spark.createDataFrame(
        [("1", "x", "s", "over de <b>factuur</b> een vraag", "t")], schemas.TICKET_EMAIL
    )
    write_csv(emails, str(tmp_path / "in"))
    files = options(input=tmp_path / "in", output=tmp_path / "out", phrases=tmp_path / "phrases")
    main(["translate-emails", *files, "--language-model", str(tmp_path / "model")])
    out = capsys.readouterr().out
    assert "over de factuur one question" in out and "Dutch" in out
