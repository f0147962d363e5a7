"""Hash trees, quality scores and source divergences against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import brute, fixtures
from ticketloom.llm import additive, divergence, merkle, veb
from ticketloom.llm.queries import QUERIES
from ticketloom.llm.wordhash import chunks

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, `rank` string, tree string, path string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def merged(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    return levels


def siblings(levels: list[list[str]], k: int) -> list[tuple[str, str]]:
    found = []
    for nodes in levels[:-1]:
        first = k - k % 3
        found.append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + 3])))
        k //= 3
    return found


def expected_proofs(rows: list[tuple]) -> list[tuple]:
    def code(value) -> str:
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    groups: dict = {}
    for row in rows:
        leaf = digest("".join(code(v) for v in row[:5]))
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf))
    trees = {name: merged([leaf for _, _, leaf in sorted(group)]) for name, group in groups.items()}
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    top = merged([trees[name][-1][0] for name in names])
    return [
        (i if given else None, leaf, trees[name][-1][0], top[-1][0], siblings(trees[name], k) + siblings(top, j))
        for j, name in enumerate(names)
        for k, (given, i, leaf) in enumerate(sorted(groups[name]))
    ]


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses_fill_the_tree_and_keep_its_parts_together(levels):
    rows = [veb.addresses(levels, depth) for depth in range(levels)]
    assert sorted(np.concatenate(rows).tolist()) == list(range(veb.size(levels)))
    if levels > 1:
        top = levels // 2
        above = np.concatenate(rows[:top])
        assert sorted(above.tolist()) == list(range(veb.size(top)))
        below = np.concatenate([row[: 3**k] for k, row in enumerate(rows[top:])])
        assert sorted(below.tolist()) == list(range(veb.size(top), veb.size(top) + veb.size(levels - top)))


def _manifest_rows() -> list[tuple]:
    rng = random.Random(5)
    rows = [(i, ("hot", None, "é", "", "z")[min(rng.randrange(9), 4)], "en", i, f"a\n{i}") for i in range(300)]
    rows += [(i, f"only {i}", None, None, None) for i in range(12)] + [rows[0]] * 3
    rows += [(None, "hot", "en", 1, "no id"), (None, "hot", "en", 1, "no id, other text"), (4, "hot", "x", 1, "")]
    rows += [(999, "long", "en", 1, "words and more " * 40_000)]
    return [(*row, "r", "t", "p") for row in rows]


@pytest.mark.parametrize("height", [1, 2, 7])
def test_proofs_are_those_of_plain_trees(spark, height):
    rows = _manifest_rows()
    found = merkle.document_proofs(spark.createDataFrame(rows, DOCS), height=height).collect()
    got = [(r["id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected_proofs(rows)))
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in found)


def test_tampering_is_found(spark):
    docs = spark.createDataFrame(_manifest_rows(), DOCS)
    text = F.when(F.col("n_chars") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    claimed = [text if f == "text" else F.col(f) for f in merkle.FIELDS]
    for r in merkle.document_proofs(docs, claimed=claimed, height=2).where("tree <> 'only 1'").collect():
        assert r["verified"] == (r["folded_root"] == r["root"])
    found = merkle.document_proofs(docs, claimed=claimed, height=2)
    wrong = {r["id"] for r in found.where("NOT verified").collect()}
    assert wrong == {r[0] for r in _manifest_rows() if r[3] is not None and r[3] % 2 == 0 and r[4] is not None}


@pytest.mark.parametrize("n", [0, 1])
def test_smallest_manifests(spark, n):
    docs = spark.createDataFrame([(1, None, None, None, None, "", "", "")] * n, DOCS)
    found = merkle.document_proofs(docs).collect()
    assert [(r["subroot"], r["root"], r["path"]) for r in found] == [(digest("1:1----"), digest("1:1----"), [])] * n


def test_manifest_query_is_that_of_plain_trees(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    rows = spark.read.parquet(f"{small}/documents.parquet").select(*merkle.FIELDS).collect()
    expected = {i: (leaf, sub, root, digest("".join(a + b for a, b in path))) for i, leaf, sub, root, path in expected_proofs(rows)}
    breaks = {r["doc_id"] for r in rows if "\n" in (r["text"] or "")}
    for r in QUERIES["op11_merkle_manifest"][0](spark, small).collect():
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) == expected.pop(r["doc_id"])
        assert r["verified"] != (r["doc_id"] in breaks and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0)
    assert not expected


def plain_divergence(rows, least: int) -> set[tuple]:
    """From (text, lang, source) rows."""
    word = brute.re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs: dict = {}
    counts: dict = {}
    for text, lang, source in rows:
        words = word.findall((text or "").translate(brute.LOWER))
        docs.setdefault(lang or "", Counter()).update(set(words))
        counts.setdefault(lang or "", {}).setdefault(source or "", Counter()).update(words)
    found = set()
    for lang, groups in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def scaled(group):
            total = sum(group[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (group[t] + 2) // total for t in kept}

        p = {source: scaled(group) for source, group in groups.items()}
        q = scaled(sum(groups.values(), Counter()))
        for source, group in groups.items():
            pairs = [
                (-sum((p[source][t] - p[o][t]) ** 2 // (p[source][t] + p[o][t]) for t in kept), o.encode(), o)
                for o in groups
                if o != source
            ]
            terms = [
                (-((p[source][t] - q[t]) ** 2 // (p[source][t] + q[t])), t.encode(), t)
                for t in kept
                if group[t] > 0 and p[source][t] > q[t]
            ]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                found |= {(lang, source, part, item, -value, k) for k, (value, _, item) in enumerate(ranked, 1)}
    return found


def _reports(spark):
    rng = random.Random(2)
    rows = [
        (fixtures.prose(rng, 30) + f" İ éÉ X{k % 3}\0y[z", rng.choice(["en", "fr", None]), ("hot", "hot", "b", "ü", None)[k % 5])
        for k in range(400)
    ]
    rows += [(None, "en", "silent"), ("12 {} \x7f", "en", "marks"), (None, "xx", "p"), ("", "xx", "q"), ("a", "yy", "alone")]
    rows += [("tie tie", "zz", f"s{k % 2}") for k in range(12)] + [("word " * 60_000, "en", "long")]
    return rows, [(*row, "clash", "clash", 1) for row in rows]


@pytest.mark.parametrize("cells, slice_bytes", [(1 << 20, 4 << 20), (40, 300)])
def test_divergences_are_exact(spark, monkeypatch, cells, slice_bytes):
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows, wide = _reports(spark)
    docs = spark.createDataFrame(wide, "text string, lang string, source string, term string, n string, shard bigint")
    found = divergence.source_divergence(docs).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == plain_divergence(rows, 10)
    assert divergence.source_divergence(docs.limit(0)).count() == 0


def test_partial_counts_are_merged(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 40)
    monkeypatch.setattr(divergence, "MERGE_ROWS", 9)
    texts = ["a b a", "B c", "", "d" * 100, "a a", "e f g h i j k"] * 5
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["l"] * 30, "source": ["s", "t"] * 15})
    total: dict = {}
    for part in divergence.partial_counts(iter([batch, batch])):
        for r in part.to_pylist():
            key = (r["source"], r["term"])
            total[key] = [x + y for x, y in zip(total.get(key, (0, 0)), (r["n"], r["docs"]), strict=True)]
    assert total[("s", "a")] == [40, 20] and total[("t", "b")] == [10, 10] and total[("s", None)] == [0, 30]


def test_scaled_is_exact_where_products_overflow():
    counts = np.array([0, 1, 3 * 10**14, 10**15 - 7, 10**15])
    for total in (10**15, 10**15 + 9):
        assert divergence.scaled(counts, total).tolist() == [1 + 10**9 * int(c) // total for c in counts]


def plain_measures(text: str) -> dict:
    words = brute.WORD.findall(text)
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x]
    pairs = list(zip(words, words[1:], strict=False))
    counts = Counter(words)
    return {
        "log_words": np.log1p(len(words)),
        "symbol_share": sum(c in "#*$%&|<>" for c in text) / max(len(text), 1),
        "bar_words": words.count("|") / n,
        "distinct_words": len(counts) / n,
        "top_word": max(counts.values(), default=0) / n,
        "adjacent_repeats": sum(a == b for a, b in pairs) / n,
        "distinct_pairs": len(set(pairs)) / max(len(pairs), 1),
        "repeated_lines": (len(lines) - len(set(lines))) / max(len(lines), 1),
        "words_per_line": len(words) / (text.count("\n") + 1),
        "short_words": sum(len(w.encode()) <= 3 for w in words) / n,
        "bangs_per_word": text.count("!") / n,
    }


def test_measures_are_those_of_whole_texts():
    texts = [t or "" for t in fixtures.texts().values()] + ["a\n\na\nb", "\n", "x | y | !! A A A", "w " * 200_000]
    found = [m for _, _, words in chunks(pa.array(texts)) for m in additive.measures(words)]
    for text, row in zip(texts, found, strict=True):
        named = dict(zip(additive.MEASURES, row, strict=True))
        for name, value in plain_measures(text).items():
            assert named[name] == pytest.approx(value), (name, text[:40])
        assert np.isfinite(row).all()


def _labelled(n: int, seed: int) -> list[tuple[int, str, int]]:
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text, bad = fixtures.prose(rng, rng.randint(5, 200)), k % 4 == 0
        if bad:
            junk = rng.randrange(3)
            text = (" | ".join(text.split()), " ".join([text.split()[0]] * 60), text.upper().replace(" ", "!! "))[junk]
        rows.append((k, text, int(not bad)))
    return rows


def test_scores_of_unseen_texts(spark):
    rows = _labelled(800, 1)
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t, _ in rows], "doc_id bigint, text string, score string, label_id string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id bigint, quality int")
    found = {r["row"]["doc_id"]: r["score"] for r in additive.quality_scores(docs, labels).collect()}
    unseen = [(found[i], y) for i, _, y in rows if i % 3 == 0]
    assert np.mean([(s >= 0.3) == y for s, y in unseen]) >= 0.97
    assert all(0 <= s <= 1 for s in found.values())
    few = additive.quality_scores(docs, labels, sample=60)
    assert np.mean([(r["score"] >= 0.3) == (r["row"]["doc_id"] % 4 != 0) for r in few.collect()]) >= 0.9


def test_scores_depend_on_the_text_alone(spark):
    rows = _labelled(300, 2)
    extra = [(1000, None), (1001, ""), (1002, rows[0][1]), (None, rows[0][1]), (1003, "x" * 400_000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + extra, "doc_id bigint, text string")
    marks = [(i, y) for i, _, y in rows] + [(None, 1), (0, None), (0, 0), (9999, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    found = [(r["row"]["doc_id"], r["score"]) for r in additive.quality_scores(docs, labels).collect()]
    score = dict(found)
    assert len(found) == len(rows) + len(extra)
    assert score[1000] == score[1001] and score[1002] == score[0] == score[None]
    again = additive.quality_scores(docs.repartition(7), labels.repartition(3))
    assert {r["row"]["doc_id"]: r["score"] for r in again.collect()} == score
    assert additive.quality_scores(docs.limit(0), labels).count() == 0
    for few, expected in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        assert {round(r["score"], 3) for r in additive.quality_scores(docs, few).collect()} == {expected}


def test_interactions_are_learned():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = additive.fit(x, y, np.arange(4000) % 5 == 4)
    assert (0, 1) in model.pairs
    fresh = rng.random((1000, 4))
    assert np.mean((model.score(fresh) >= 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))) >= 0.9


def test_held_out_quality(spark, sf_dir):
    found = QUERIES["op12_quality_additive"][0](spark, sf_dir).collect()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in found)
    held = [(r["score"], quality[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in quality]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins >= 0.98 and np.mean([s >= 0.3 for s in good]) >= 0.97
