"""Near-duplicates, lines, quality, contamination and repeated passages against plain versions."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm import brute, fixtures
from ticketloom.llm import decontaminate, line_dedup, neardup, phrases, quality

TEXTS = fixtures.texts()


@pytest.fixture(scope="module")
def docs(spark):
    return fixtures.table(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], fixtures.SCHEMA)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, width):
    found = neardup.near_duplicates(docs, width=width).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute.near_duplicates(
        TEXTS, width
    )


def test_near_duplicates_of_repeated_and_null_ids(spark):
    base = fixtures.prose(random.Random(3), 80)
    rows = [(1, "p q r s"), (1, base), (2, base), (3, base), (3, base), (None, base), (4, "p q r s")]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()
    assert sorted((r["id"] or 0, r["component_id"] or 0, r["kept"]) for r in found) == [
        (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (3, 1, False), (4, 1, False)
    ]


def test_sketches_of_few_shingles_rarely_miss_a_link():
    import numpy as np

    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(10_000):  # links at a similarity of 0.8 exactly
        x = rng.integers(0, 1 << 64, 10, dtype=np.uint64)
        same = neardup._sketches(x[:9]) == neardup._sketches(x[[*range(8), 9]])
        missed += not (same[: neardup.SKETCHES].any() and same[neardup.SKETCHES :].any())
    assert missed <= 8


def test_bands_of_short_lines_rarely_miss_a_link(spark):
    rng = random.Random(7)
    lines = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=15)) for _ in range(4000)]
    rows = [(i, f"{x}!\n{x}?", i) for i, x in enumerate(lines)]  # 8 of 10 shingles in both
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, number bigint")
    found = line_dedup._classes(line_dedup._lines(docs, "doc_id", "text", "number")).groupBy("first_row")
    pairs = found.agg(F.collect_list("bands").alias("b"))
    missed = pairs.where(~F.arrays_overlap(F.col("b")[0], F.col("b")[1])).count()
    assert missed <= 12


def test_large_group_of_near_copies_is_not_paired(spark):
    rng = random.Random(5)
    base = fixtures.prose(rng, 120)
    texts = {i: fixtures.edited(rng, base, rng.randint(0, 9)) for i in range(150)}
    found = neardup.near_duplicates(fixtures.table(spark, texts), width=2).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute.near_duplicates(texts, 2)


def test_line_dedup(docs):
    gone = brute.dropped_lines(TEXTS, line_dedup.WIDTH)
    found = line_dedup.dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines_", "n_dropped"]
    for r in found.collect():
        text = TEXTS[r["doc_id"]]
        lines = None if text is None else text.split("\n")
        left = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone[r["doc_id"]])
        assert (r["text"], r["n_lines_"], r["n_dropped"]) == (left, len(lines or []), len(gone[r["doc_id"]]))


def test_line_dedup_of_null_ids_comes_last(spark):
    rows = [(None, "a line of words\nanother"), (7, "a line of words"), (None, None)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "NULL") for r in found) == [
        (0, "NULL"), (0, "another"), (7, "a line of words")
    ]


def test_line_dedup_takes_lines_of_each_row_alone(spark):
    rng = random.Random(12)
    line, *own = (fixtures.prose(rng, 12) for _ in range(7))
    rows = [
        (1, f"{own[0]}\n{line}"),
        (None, f"{own[1]}\n{line}"), (None, f"{own[2]}\n{own[3]}"),
        (5, f"{own[4]}\n{line}"), (5, f"{line}\n{own[5]}"),
        (None, own[0]), (None, own[0]),
    ]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["n_lines"], r["n_dropped"]) for r in found) == sorted([
        (1, rows[0][1], 2, 0), (0, own[1], 2, 1), (0, rows[2][1], 2, 0), (5, own[4], 2, 1), (5, own[5], 2, 1),
        (0, "", 1, 1), (0, "", 1, 1),
    ])


def test_line_dedup_keeps_one_of_repeated_rows(spark):
    rows = [(None, "a line of many words")] * 3 + [(4, "some other words here")] * 2
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["text"], r["n_dropped"]) for r in found) == [
        ("", 1), ("", 1), ("", 1), ("a line of many words", 0), ("some other words here", 0)
    ]


def test_quality_base_counts(docs):
    found = quality.quality_rules(docs)
    assert found.select("row.*").columns == docs.columns
    for r in found.collect():
        expected = brute.base_counts(TEXTS[r["row"]["doc_id"]])
        assert tuple(r[c] for c in quality.METRICS.names[:5]) == expected
        assert r["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert (r["perplexity"] is None) == (expected[0] == 0)
        assert not (r["kept"] and r["base_failed"])


def test_quality_bands_reject_what_is_unlike_its_language(spark):
    rng = random.Random(2)
    rows = [(i, fixtures.prose(rng, rng.randint(60, 200)), "en") for i in range(120)]
    rows += [(500, " ".join("".join(rng.choices("qxzjkvw", k=8)) for _ in range(80)), "en")]
    found = quality.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert [r["row"]["doc_id"] for r in found.where("NOT kept").collect()] == [500]


def test_quality_rejects_known_words_in_random_order(spark):
    rng = random.Random(6)
    names = sorted({fixtures.prose(rng, 1) for _ in range(300)})
    after = {w: rng.sample(names, 3) for w in names}

    def ordered(n):
        words = [rng.choice(names)]
        while len(words) < n:
            words.append(rng.choice(after[words[-1]]))
        return words

    rows = [(i, " ".join(ordered(rng.randint(80, 200))), "en") for i in range(150)]
    salad = rows[7][1].split(" ")
    rng.shuffle(salad)
    rows.append((500, " ".join(salad), "en"))
    found = quality.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert [r["row"]["doc_id"] for r in found.where("NOT kept").collect()] == [500]


def test_word_perplexity_leaves_the_text_out(spark):
    """Each text is scored as by a model counted over the others, with the discounts of all."""
    import numpy as np

    from ticketloom.llm import wordmodel

    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcde", k=rng.randint(1, 30))) for _ in range(12)] + ["a b a b"] * 2
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    found = {(r["h1"], r["h2"]): r for r in wordmodel.word_surprise(docs, "text", "lang").collect()}
    prints = docs.select("text", *wordmodel.text_prints("text")).distinct().collect()
    assert len(found) == len(prints)
    for row in prints:
        others = list(texts)
        others.remove(row["text"])
        expected = brute.word_surprise(row["text"], others, texts)
        got = found[row["h1"], row["h2"]]
        assert got["word_n"] == len(row["text"].split()) + 1
        assert got["word_surprise"] == pytest.approx(expected)


@pytest.mark.parametrize("shard", [8, 1 << 19])
def test_word_perplexity_of_many_blocks_and_shards(spark, monkeypatch, shard):
    """Frequent words are dealt over several shards; texts of a block are scored in parts."""
    from ticketloom.llm import wordmodel

    rng = random.Random(9)
    texts = [" ".join(rng.choices("aaaabcdefgh", k=rng.randint(1, 40))) for _ in range(40)]
    texts += ["a b a b"] * 2 + ["x y z " * 30]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(3)
    monkeypatch.setattr(wordmodel, "SHARD", shard)
    monkeypatch.setattr(wordmodel, "BLOCK", 100)
    monkeypatch.setattr(wordmodel, "SCORED", 50)
    if shard == 8:
        blocks = wordmodel.token_blocks(docs, "text", "lang")
        assert blocks.count() > 2
        assert len(wordmodel._frequent(blocks, blocks.count())["en"]) > 5
    found = {(r["h1"], r["h2"]): r for r in wordmodel.word_surprise(docs, "text", "lang").collect()}
    prints = docs.select("text", *wordmodel.text_prints("text")).distinct().collect()
    assert len(found) == len(prints)
    for row in prints:
        others = list(texts)
        others.remove(row["text"])
        got = found[row["h1"], row["h2"]]
        assert got["word_n"] == len(row["text"].split()) + 1
        assert got["word_surprise"] == pytest.approx(brute.word_surprise(row["text"], others, texts))


def test_language_model_is_a_distribution(spark):
    """After every context the probabilities of all symbols add up to one."""
    import numpy as np

    words = " ".join(["the", "then", "there", "an", "ant", "on", "one", "no"] * 3 + ["zed"])
    docs = spark.createDataFrame([(words, "en")], "text string, lang string")
    model = quality._models(quality.kneser_ney(quality.ngram_counts(docs, "text", "lang")))["en"]
    for context in ("\0\0\0", "\0\0t", "\0th", "the", "zzz", "one"):
        packed = 0
        for c in context:
            packed = packed << quality.BITS | (0 if c == "\0" else int(quality.SYMBOLS[ord(c)]))
        grams = np.arange(64, dtype=np.uint32) | np.uint32(packed << quality.BITS)
        assert np.exp(model.log_probability(grams)).sum() == pytest.approx(1, abs=1e-3)


def test_languages_in_groups_give_the_same(docs, monkeypatch):
    def result():
        return sorted(
            (r["row"]["doc_id"], r["perplexity"], r["kept"]) for r in quality.quality_rules(docs, ["doc_id"]).collect()
        )

    whole = result()
    monkeypatch.setattr(quality, "MODEL_ENTRIES", 1)
    assert [(i, pytest.approx(p) if p else p, k) for i, p, k in result()] == whole


def test_contamination(spark, docs):
    rng = random.Random(9)
    passage = TEXTS[40].split(" ")[40:100]
    items = {
        0: " ".join(passage[:30]),
        1: fixtures.edited(rng, " ".join(passage[10:60]), 1).upper(),
        2: fixtures.prose(rng, 25),
        3: None,
        4: " ",
        5: "one",
        6: "same same same same same same same",
        7: " ".join(["a b c"] * 4),
    }
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    expected = brute.contaminated(TEXTS, items)
    assert {(r["doc_id"], r["item_id"]): (r["start"], r["shared"]) for r in found} == expected
    assert any(i == 40 for i, _ in expected) and (5, 5) in expected
    left = decontaminate.without_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == set(TEXTS) - {i for i, _ in expected}


def test_repeated_passages(docs):
    found = {r["doc_id"]: r for r in phrases.without_repeats(docs).collect()}
    for i, (n, kept) in zip(TEXTS, brute.repeats_removed(list(TEXTS.values())), strict=True):
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert (found[i]["n_words"], found[i]["n_removed"], found[i]["kept_sha256"]) == (n, n - len(kept), digest)


def test_repeated_passages_of_repeated_rows_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_PHRASES", 3)
    monkeypatch.setattr(phrases, "GROUP_BYTES", 500)
    rng = random.Random(4)
    one, other = fixtures.prose(rng, 90), fixtures.prose(rng, 70)
    rows = [(1, one), (1, one), (None, f"x {other}"), (None, f"{other} y"), (2, fixtures.prose(rng, 50))]
    found = phrases.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in found) == [
        (0, 71, 70), (0, 71, 70), (1, 90, 90), (1, 90, 90), (2, 50, 0)
    ]


def test_repeated_passages_of_a_very_long_text(spark, monkeypatch):
    """A text of several blocks that owns all recurring phrases: they are dealt into many shards."""
    monkeypatch.setattr(phrases, "SHARD_PHRASES", 40)
    rng = random.Random(14)
    long = [fixtures.prose(rng, 400) for _ in range(150)]
    texts = {
        1: " ".join(long),
        2: "new " + " ".join(long[20:40]) + " words",
        3: long[77] + " and " + fixtures.prose(rng, 40),
        4: fixtures.prose(rng, 3000),
    }
    assert len(texts[1]) > 262_144
    found = phrases.without_repeats(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    found = {r["doc_id"]: r for r in found.collect()}
    for i, (n, kept) in zip(texts, brute.repeats_removed(list(texts.values())), strict=True):
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert (found[i]["n_words"], found[i]["n_removed"], found[i]["kept_sha256"]) == (n, n - len(kept), digest)
    assert found[2]["n_removed"] == 8000 and found[3]["n_removed"] == 400


def test_texts_are_shuffled_once_on_their_way_to_the_automata(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    anchor = [(7, 0)]
    candidates = spark.createDataFrame(
        [(k, "a b c d e f g h", anchor) for k in range(4)], f"row_id bigint, text string, anchors {phrases.ANCHORS}"
    )
    patterns = spark.createDataFrame([(0, 1, None), (0, None, "a b c d e f g h")], "shard int, window bigint, words string")
    runs = phrases._runs(candidates, patterns)
    assert runs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert sorted(r["row_id"] for r in runs.collect()) == [0, 1, 2, 3]


def test_recurring_phrases_in_parts(spark):
    rows = [(k, 7) for k in range(25_000)] + [(100_000 + k, k) for k in range(500)]
    dealt = phrases._sharded(spark.createDataFrame(rows, "phrase bigint, owner bigint"), 4)
    sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 1


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([], "item_id bigint, text string")
    for found in (
        neardup.near_duplicates(empty),
        line_dedup.dedup_lines(empty),
        quality.quality_rules(empty),
        decontaminate.contaminated(empty, spark.createDataFrame([(1, "a b c d e f")], items.schema)),
        decontaminate.without_contaminated(empty, items),
        phrases.without_repeats(empty),
    ):
        assert found.count() == 0


def test_no_benchmark_items(spark, docs):
    items = spark.createDataFrame([(1, None)], "item_id bigint, text string")
    assert decontaminate.contaminated(docs, items).count() == 0
    assert decontaminate.without_contaminated(docs, items).count() == docs.count()


@pytest.mark.parametrize("columns", [["doc_id", "text", "lang"], ["text", "lang", "doc_id"]])
def test_results_do_not_depend_on_the_order_of_columns(docs, columns):
    got = quality.quality_rules(docs.select(*columns)).where(F.col("row.doc_id") == 50).first()
    assert got["base_failed"] and got["n_words"] == 180
