"""How far the sources of a language differ in their words, in exact integer arithmetic.

Arrow kernels split and count the words inside the tasks: only partial counts are
shuffled, once. The kept counts of a language are dealt to shards by term, each a
small matrix of sources and terms, and the shards' divergences are added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.shared import saved

# What stands between terms, and the scale of a probability.
BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE_STEPS = (1000, 1000, 1000)

MIN_DOCS = 10
TOP_TERMS = 10
SLICE_BYTES = 4 << 20
MERGE_ROWS = 1 << 19
CELLS = 1 << 17
PARTIAL = "lang string, source string, term string, n bigint, docs bigint"
FOUND = "lang string, source string, part string, item string, value bigint"
KEYS = ["lang", "source", "term"]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about SLICE_BYTES of text, or one row at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(low, high - low)
        low = high


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """PARTIAL of some documents; a row without term counts the documents of a group."""
    group = pa.table({k: batch.column(k) for k in ("lang", "source")}).append_column(
        "term", pa.nulls(len(batch), pa.string())
    )
    whole = group.group_by(KEYS).aggregate([([], "count_all")])
    whole = whole.append_column("n", pa.array(np.zeros(len(whole), np.int64)))
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=BREAK)
    rows, terms = pc.list_parent_indices(parts), pc.list_flatten(parts)
    real = pc.not_equal(terms, "")
    coded = terms.filter(real).dictionary_encode()
    found = pa.table({"row": rows.filter(real), "code": coded.indices})
    by_row = found.group_by(["row", "code"]).aggregate([([], "count_all")])
    groups = pc.binary_join_element_wise(batch.column("lang"), batch.column("source"), "\0").dictionary_encode()
    by_group = (
        pa.table(
            {
                "group": groups.indices.take(by_row.column("row")),
                "code": by_row.column("code"),
                "times": by_row.column("count_all"),
            }
        )
        .group_by(["group", "code"])
        .aggregate([("times", "sum"), ("times", "count")])
    )
    first = pc.index_in(pa.array(range(len(groups.dictionary)), pa.int32()), groups.indices)
    at = first.take(by_group.column("group"))
    counted = pa.table(
        {
            "lang": batch.column("lang").take(at),
            "source": batch.column("source").take(at),
            "term": coded.dictionary.take(by_group.column("code")),
            "n": by_group.column("times_sum"),
            "docs": by_group.column("times_count"),
        }
    )
    return pa.concat_tables([whole.rename_columns([*KEYS, "docs", "n"]).select(counted.column_names), counted])


def _merged(tables: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(tables).group_by(KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return total.rename_columns([*KEYS, "n", "docs"])


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts, merged as long as MERGE_ROWS rows of them hold what comes."""
    held: list[pa.Table] = []
    n = 0
    for batch in batches:
        for piece in _slices(batch):
            held.append(term_counts(piece))
            n += len(held[-1])
            if n > MERGE_ROWS:
                held = [_merged(held)]
                n = len(held[0])
                if n > MERGE_ROWS // 2:
                    yield from held[0].to_batches(1 << 16)
                    held, n = [], 0
    if held:
        yield from _merged(held).to_batches(1 << 16)


def scaled(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(10**9 * counts / total)``, digit by digit, so that no product overflows.

    Exact while ``counts <= total < 9 * 10**15``.
    """
    quotient = np.zeros_like(counts)
    rest = counts
    for step in SCALE_STEPS:
        rest = rest * step
        quotient = quotient * step + rest // total
        rest = rest % total
    return quotient + 1


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def shard_divergences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FOUND of one shard: rows without term give the sources of its language, their totals
    and how many terms the language has; the others the counts of the shard's terms."""
    rows = pa.Table.from_batches(list(batches))
    lang = rows.column("lang")[0].as_py()
    is_source = pc.is_null(rows.column("term"))
    sources = rows.filter(is_source)
    kept = sources.column("kept")[0].as_py()
    names = sources.column("source").combine_chunks()
    totals = sources.column("n").to_numpy()
    cells = rows.filter(pc.invert(is_source))
    terms = pc.unique(cells.column("term"))
    terms = terms.take(pc.sort_indices(terms))
    counts = np.zeros((len(names), len(terms)), np.int64)
    at = [pc.index_in(cells.column(k), v).to_numpy() for k, v in (("source", names), ("term", terms))]
    np.add.at(counts, tuple(at), cells.column("n").to_numpy())
    p = scaled(counts + 2, totals[:, None] + 2 * kept) if len(terms) else counts
    q = scaled(counts.sum(axis=0) + 2, int(totals.sum()) + 2 * kept) if len(terms) else counts
    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string()) for c in FOUND.split(", ")])

    def batch(source: str, part: str, items: pa.Array, values: np.ndarray) -> pa.RecordBatch:
        same = [pa.array([v] * len(items), pa.string()) for v in (lang, source, part)]
        return pa.RecordBatch.from_arrays([*same, items, pa.array(values, pa.int64())], schema=schema)

    for k, source in enumerate(names.to_pylist()):
        others = np.flatnonzero(np.arange(len(names)) != k)
        yield batch(source, "pair", names.take(pa.array(others)), _distance(p, p[k]).sum(axis=1)[others])
        if len(terms):
            more = np.flatnonzero((counts[k] > 0) & (p[k] > q))
            value = _distance(p[k][more], q[more])
            best = np.argsort(-value, kind="stable")[:TOP_TERMS]
            yield batch(source, "term", terms.take(pa.array(more[best])), value[best])


def source_divergence(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least_docs: int = MIN_DOCS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how sources of a language differ.

    A term is a run of letters or of characters beyond ASCII, with A-Z lower-cased. A
    language keeps the terms that at least ``least_docs`` of its documents have; a group's
    probability of a kept term is smoothed by two, in units of 10**-9. Part ``pair`` ranks all
    other sources of the language by the divergence over all kept terms, part ``term`` gives
    the TOP_TERMS kept terms that the source has more of than its language. Ties go by item.

    NULL text, language and source count as ''; repeated rows count each; a source without
    terms has its pairs, of value 0 where its language keeps no term; an only source has
    none; no documents give no rows. Other columns take no part.

    A shard has about CELLS cells of sources and terms, a hot source or language many shards.
    The result has all pairs of sources of a language and so grows with their square.
    """
    texts = docs.select(
        *[
            F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)
            for column, name in ((text_column, "text"), (lang_column, "lang"), (source_column, "source"))
        ]
    )
    # By language and term alone: what follows groups by source and then without it, all in this one shuffle.
    dealt = texts.mapInArrow(partial_counts, PARTIAL).repartition("lang", "term")
    counts = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    table = saved(by_term.where(F.col("term").isNull() | (F.col("docs") >= least_docs)), "term-counts")
    kept = table.where("term IS NOT NULL").select("lang", "term", "counts")
    groups = table.where("term IS NULL").select("lang", F.inline("counts")).select("lang", "source")

    totals = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    members = (
        groups.join(totals, ["lang", "source"], "left")
        .join(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")), "lang")
        .join(sizes, "lang", "left")
        .select("lang", "source", "n_sources", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n", "kept")])
    )
    shards = F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("n_sources") / CELLS))
    members = saved(members.withColumn("shards", shards), "sources")
    languages = members.groupBy("lang").agg(F.first("shards").alias("shards"))
    cells = kept.join(languages, "lang").select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"),
        "term",
        F.lit(None).cast("bigint").alias("kept"),
        F.inline("counts"),
    )
    heads = members.select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"),
        F.lit(None).cast("string").alias("term"),
        "kept",
        "source",
        "n",
    )
    found = cells.unionByName(heads).groupBy("lang", "shard").applyInArrow(shard_divergences, FOUND)
    total = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return total.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))
