"""What the operators leave in the shared folder, and that work done in turns gives the same rows."""

from __future__ import annotations

import random
import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from llm import brute, fixtures
from ticketloom.llm import line_dedup, links, neardup, shared, wordmodel


@pytest.fixture
def shared_folder(monkeypatch, tmp_path):
    folder = tmp_path / "shared"
    folder.mkdir()
    for module in (shared, wordmodel):
        monkeypatch.setattr(module, "shared_path", lambda _, name: f"{folder}/{name}-{uuid.uuid4().hex}")
    return folder


def left_in(folder: Path) -> set[str]:
    """Names of the tables that have files."""
    return {p.relative_to(folder).parts[0].rpartition("-")[0] for p in folder.rglob("part-*.parquet")}


def written(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def test_line_dedup_of_files_writes_no_copy_and_leaves_only_what_it_reads(spark, tmp_path, shared_folder):
    rng = random.Random(3)
    own = [fixtures.prose(rng, 12) for _ in range(6)]
    rows = [(1, f"{own[0]}\n{own[1]}"), (2, f"{own[1]}\n{own[2]}"), (2, f"{own[3]}\n{own[1]}"), (None, own[0]), (3, None), (4, own[4])]
    docs = written(spark, tmp_path, rows, "doc_id bigint, text string")
    found = line_dedup.dedup_lines(docs, in_files=True)
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["n_lines"], r["n_dropped"]) for r in found.collect()) == sorted([
        (1, rows[0][1], 2, 0), (2, own[2], 2, 1), (2, own[3], 2, 1), (0, "", 1, 1), (3, "", 0, 0), (4, own[4], 1, 0)
    ])
    assert left_in(shared_folder) == {"dropped-lines"}


def test_rows_of_files_are_numbered_alike_in_every_read_and_others_too(spark, tmp_path, shared_folder):
    docs = written(spark, tmp_path, [(7, "a")] * 50, "doc_id bigint, text string")
    found = shared.numbered_in_files(docs.select("doc_id"), "row")
    rows = [r["row"] for r in found.collect()]
    assert len(set(rows)) == 50 and sorted(r["row"] for r in found.select("row").collect()) == sorted(rows)
    assert left_in(shared_folder) == set()
    assert shared.numbered_in_files(spark.range(9), "row").select("row").distinct().count() == 9


def test_narrowed_keeps_all_that_is_wanted_and_little_else(spark):
    wanted = spark.range(0, 50_000, 5)
    found = shared.narrowed(spark.range(50_000), wanted, "id")
    assert wanted.exceptAll(found).isEmpty() and found.count() < 14_000
    gone = shared.without(spark.range(50_000), wanted, "id")
    assert gone.count() == 40_000 and gone.where("id % 5 = 0").isEmpty()
    assert shared.without(spark.range(9), wanted.limit(0), "id").count() == 9


def test_pairs_verified_in_turns_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(links, "PAIRS", 4)
    rng = random.Random(5)
    base = [fixtures.prose(rng, 80) for _ in range(2)]
    texts = {i: fixtures.edited(rng, base[i % 2], rng.randint(0, 7)) for i in range(40)}
    found = neardup.near_duplicates(fixtures.table(spark, texts), width=2).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute.near_duplicates(texts, 2)


def test_quality_stage_leaves_no_copy_of_the_texts(spark, tmp_path, shared_folder):
    rng = random.Random(8)
    rows = [(i, fixtures.prose(rng, 80), "en") for i in range(12)] + [(12, "too short", "en"), (None, None, None)]
    docs = written(spark, tmp_path, rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.quality(spark, docs, "")
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids and ids <= set(range(12))
    assert not any("text" in str(pq.read_schema(p)) for p in shared_folder.rglob("part-*.parquet"))
    assert not left_in(shared_folder) & {"word-blocks", "word-answers", "word-scores", "word-continuations"}
