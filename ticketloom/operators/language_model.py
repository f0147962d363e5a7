"""A language detector that is trained on labelled texts: multinomial naive Bayes over hashed trigrams.

The counts are made by Spark over all labelled texts, the model is a table with a weight
per language and bucket, and a text's score is a sum of whole numbers, so that the same
texts and model give the same answer everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.grams import BUCKETS, trigram_buckets
from ticketloom.functions.language import UNKNOWN

# Weights are logarithms in millionths. Two rows of each language are no buckets.
SCALE = 1_000_000
UNSEEN, PRIOR = -1, -2
# The best language must be so many times as likely as the next one.
ODDS = 1000.0
_COUNTS = "language string, bucket int, n bigint"


def trigram_counts(df: DataFrame, column: str, language: str) -> DataFrame:
    """``(language, bucket, n)``: trigrams of all texts of each language; bucket PRIOR counts texts.

    Rows without a language are left out. Counted per Arrow batch, so that a task sends at
    most a row per language and bucket and batch into Spark's own map-side sums.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            names = coded.dictionary.to_pylist()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.zeros((len(names), BUCKETS), np.int64)
            row = 0
            for buckets, first in trigram_buckets(batch.column(0)):
                n = len(first) - 1
                own = np.repeat(codes[row : row + n], np.diff(first))
                total += np.bincount(own * BUCKETS + buckets, minlength=total.size).reshape(total.shape)
                row += n
            at, bucket = np.nonzero(total)
            texts = np.bincount(codes, minlength=len(names))
            every = np.arange(len(names))
            columns = [
                pa.array([names[k] for k in np.concatenate([at, every])], pa.string()),
                pa.array(np.concatenate([bucket, np.full(len(names), PRIOR)]), pa.int32()),
                pa.array(np.concatenate([total[at, bucket], texts])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["language", "bucket", "n"])

    rows = df.where(F.col(language).isNotNull()).select(F.col(column).cast("string"), F.col(language).cast("string"))
    return rows.mapInArrow(count, _COUNTS).groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def train_language_model(df: DataFrame, column: str = "text", language: str = "lang") -> DataFrame:
    """``(language, bucket, weight)``: the logarithm of each bucket's share in the language's
    trigrams, smoothed by one, of what unseen buckets get (UNSEEN) and of the language's
    share in the texts (PRIOR). At most BUCKETS + 2 rows a language, whatever the texts."""
    counts = trigram_counts(df, column, language)
    seen = F.col("bucket") != PRIOR
    totals = counts.groupBy("language").agg(
        F.coalesce(F.sum(F.when(seen, F.col("n"))), F.lit(0)).alias("grams"), F.sum(F.when(~seen, F.col("n"))).alias("texts")
    )
    rows = totals.select(
        "language", F.explode(F.array(F.lit(UNSEEN), F.lit(PRIOR))).alias("bucket"), "grams", "texts"
    )
    every = totals.agg(F.sum("texts").alias("every"))

    def weight(part: Column, whole: Column) -> Column:
        return F.round(F.log(part / whole) * SCALE).cast("bigint").alias("weight")

    smoothed = F.col("grams") + BUCKETS
    ends = rows.select(
        "language",
        "bucket",
        F.when(F.col("bucket") == PRIOR, weight(F.col("texts"), every.scalar())).otherwise(weight(F.lit(1), smoothed)).alias("weight"),
    )
    counted = counts.where(seen).join(totals, "language")
    return counted.select("language", "bucket", weight(F.col("n") + 1, smoothed)).unionByName(ends)


@dataclass(frozen=True)
class LanguageModel:
    """The table of ``train_language_model`` as arrays: a few numbers per language and bucket."""

    languages: list[str]
    weights: np.ndarray
    prior: np.ndarray
    odds: float = ODDS

    @classmethod
    def of(cls, table: DataFrame, odds: float = ODDS) -> LanguageModel:
        """Reads the table to the driver; its size depends on the number of languages alone."""
        rows = table.toPandas()
        languages = sorted(rows["language"].unique())
        code = rows["language"].map({name: k for k, name in enumerate(languages)}).to_numpy(np.int64)
        weights, prior = np.zeros((len(languages), BUCKETS), np.int64), np.zeros(len(languages), np.int64)
        bucket, weight = rows["bucket"].to_numpy(np.int64), rows["weight"].to_numpy(np.int64)
        for kind, fill in ((UNSEEN, weights), (PRIOR, prior)):
            own = bucket == kind
            fill[code[own]] = weight[own][:, None] if kind == UNSEEN else weight[own]
        own = bucket >= 0
        weights[code[own], bucket[own]] = weight[own]
        return cls(languages, weights, prior, odds)

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each text's score by language, and how many trigrams it has."""
        parts, sizes = [np.zeros((0, len(self.languages)), np.int64)], [np.zeros(0, np.int64)]
        for buckets, first in trigram_buckets(texts):
            part = np.empty((len(first) - 1, len(self.languages)), np.int64)
            for k, weights in enumerate(self.weights):
                total = np.concatenate([[0], np.cumsum(weights[buckets])])
                part[:, k] = self.prior[k] + total[first[1:]] - total[first[:-1]]
            parts.append(part)
            sizes.append(np.diff(first))
        return np.concatenate(parts), np.concatenate(sizes)

    def answers(self, texts: pa.Array) -> pa.Array:
        """The best language of each text; 'unknown' without letters or if the next one is too close."""
        scores, sizes = self.scores(texts)
        if not self.languages:
            return pa.array([UNKNOWN] * len(texts), pa.string())
        best = scores.argmax(axis=1)
        if len(self.languages) > 1:
            top = np.partition(scores, -2, axis=1)[:, -2:]
            sure = top[:, 1] - top[:, 0] >= round(np.log(self.odds) * SCALE)
        else:
            sure = np.ones(len(best), bool)
        names = np.array([*self.languages, UNKNOWN], object)
        return pa.array(names[np.where(sure & (sizes > 0), best, len(self.languages))], pa.string())

    def detect(self, text: Column) -> Column:
        """The language of a text column; runs on Arrow batches in the tasks, so that a task holds
        no batch as Python strings."""

        def ask(texts: pa.Array) -> pa.Array:
            return self.answers(texts)

        return F.arrow_udf(ask, "string")(text)
