from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import values
from ticketloom import schemas, session
from ticketloom.functions import dates
from ticketloom.plans import associations, emails, extract
from ticketloom.sinks.csv_files import write_csv, write_csv_run
from ticketloom.sources.csv_files import read_csv
from ticketloom.sources.tables import read_table

TRICKY = [
    ("1", 'line1\nline2, "q"'),
    ("2", "plain"),
    ("3", 'x"y'),
    ("4", ""),
    ("5", None),
    ("6", "  padded  "),
    ("7", "cr\r\nlf"),
    ("8", "back\\slash\\"),
    ("9", '\\"'),
    (None, "no id"),
]
SCHEMA = "ticket_id string, content string"


def test_roundtrip_is_exact(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, SCHEMA)
    write_csv(df, str(tmp_path / "out"))
    assert values(read_csv(spark, str(tmp_path / "out"), df.schema)) == sorted(TRICKY, key=repr)


def test_reads_what_pandas_writes(spark, tmp_path):
    rows = [r for r in TRICKY if r[0] and r[1]]
    pd.DataFrame(rows, columns=["ticket_id", "content"]).to_csv(tmp_path / "in.csv", index=False)
    back = read_csv(spark, str(tmp_path / "in.csv"), T.StructType.fromDDL(SCHEMA), partitions=4)
    assert values(back) == sorted(rows, key=repr)
    assert back.rdd.getNumPartitions() == 4


def test_files_are_limited_and_existing_output_is_kept(spark, tmp_path):
    df = spark.range(0, 1000, 1, 1)
    write_csv(df, str(tmp_path / "out"), max_records_per_file=300)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 4
    with pytest.raises(Exception, match="(?i)exists"):
        write_csv(df, str(tmp_path / "out"))


def test_run_directories_are_stamped(spark, tmp_path):
    path = write_csv_run(spark.range(3), str(tmp_path), dt.datetime(2025, 3, 18, 11, 33, 5))
    assert path.endswith("/run=20250318_113305")
    assert spark.read.csv(path, header=True).count() == 3


def test_cutoff_text():
    assert dates.cutoff_text(30, dt.date(2024, 5, 31)) == "2024-05-01"


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return {}


class FakeSession:
    def __init__(self, master, **conf):
        self.conf, self.sparkContext = conf, FakeContext(master)


def test_shared_path_is_the_one_the_session_names():
    named = FakeSession("spark://host", **{"spark.checkpoint.dir": "s3a://bucket/shared/"})
    one, two = session.shared_path(named, "t"), session.shared_path(named, "t")
    assert one.startswith("s3a://bucket/shared/t-") and one != two
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_path(FakeSession("spark://host"), "t")
    local = FakeSession("local[2]", **{"spark.sql.warehouse.dir": "/w"})
    assert session.shared_path(local, "t").startswith("/w/intermediate/t-")


def test_one_column_keeps_null_empty_and_blank(spark, tmp_path):
    rows = [(None,), ("",), (" ",), ("a\nb",), ('"',), (None,)]
    df = spark.createDataFrame(rows, "value string")
    write_csv(df, str(tmp_path / "out"))
    assert values(read_csv(spark, str(tmp_path / "out"), df.schema)) == sorted(rows, key=repr)


def test_process_email_content(spark, tmp_path):
    rows = [
        ("1", "a1", "s", "<p>Ik heb een vraag &amp; het werkt niet</p>", "t"),
        ("2", "a2", "s", "The customer has\na question about this", "t"),
        ("3", "a3", "s", " ", "t"),
        ("4", "a4", "s", None, "t"),
    ]
    source = str(tmp_path / "in")
    write_csv(spark.createDataFrame(rows, schemas.TICKET_EMAIL), source)
    out = emails.process_email_content(spark, source, str(tmp_path / "out"))
    expected = [
        ("1", "Dutch", "I have a question & the works not"),
        ("2", "English", "The customer has a question about this"),
        ("3", "unknown", ""),
        ("4", "unknown", ""),
    ]
    assert values(out, "ticket_id", "detected_language", "translated_content") == expected
    again = emails.process_email_content(spark, source, str(tmp_path / "out"))
    assert again.count() == 4
    stats = emails.language_statistics(again)
    assert [tuple(r) for r in stats.counts.collect()] == [("unknown", 2), ("Dutch", 1), ("English", 1)]
    assert values(stats.mentions) == [(1,)]


def test_dump_recent_tickets(spark, tmp_path):
    raw = spark.createDataFrame(
        [(str(i), f"s{i}", "c" * 100, dt.datetime(2024, 5, 31) - dt.timedelta(days=i)) for i in range(40)],
        "id string, property_subject string, property_content string, property_createdate timestamp",
    )
    raw.write.parquet(str(tmp_path / "raw"))
    dump = extract.dump_recent_tickets(
        spark, str(tmp_path / "raw"), str(tmp_path), "2024-05-31", moment=dt.datetime(2024, 6, 1)
    )
    assert dump.path.endswith("tickets_last_month/run=20240601_000000")
    assert read_csv(spark, dump.path, raw.schema).count() == 31
    assert [r.id for r in dump.preview.collect()] == ["0", "1", "2", "3", "4"]
    profile = dump.profile.orderBy("position").collect()
    assert [(r.column_name, r.column_type) for r in profile] == raw.dtypes
    assert {(r.n_columns, r.n_rows) for r in profile} == {(4, 40)}
    assert values(dump.written) == [(31, 4)]


def test_extract_reads_named_tables(spark, tmp_path):
    day = dt.datetime(2024, 5, 31)
    mart = spark.createDataFrame([("1", day, "s", "Support", "EMAIL")], schemas.TICKET_MART)
    mart.createOrReplaceTempView("mart_tickets")
    spark.createDataFrame([("1", "body")], "id string, property_content string").createOrReplaceTempView(
        "raw_tickets"
    )
    out = extract.extract_support_tickets(
        spark, "mart_tickets", "raw_tickets", "table", as_of="2024-05-31"
    )
    assert values(out) == [("1", day, "s", "body")]


def test_export_merged(spark, tmp_path):
    t = spark.createDataFrame([("1", "s"), ("2", "s")], "id string, subject string")
    e = spark.createDataFrame([("1", "a", "t", "c")], schemas.ASSOCIATION)
    path = associations.export_merged(t, e, str(tmp_path))
    back = spark.read.csv(path, header=True)
    assert values(back, "id", "ticket_id") == [("1", "1"), ("2", None)]
    rejected = spark.createDataFrame([("2", "timeout")], "ticket_id string, status string")
    path = associations.export_merged(t, e, str(tmp_path / "known"), rejected=rejected)
    assert values(spark.read.csv(path, header=True), "id", "ticket_id") == [("1", "1")]


def test_read_table_prunes_columns(spark, sf_dir):
    df = read_table(spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey"])
    assert df.columns == ["o_orderkey"]
    plan = df.agg(F.max("o_orderkey"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
