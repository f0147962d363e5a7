"""The trained language detector over the documents: a fifth of them is left for measuring it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.grams import BUCKETS, FACTOR
from ticketloom.operators import language as ops
from ticketloom.operators.language_model import ODDS, PRIOR, SCALE, LanguageModel, train_language_model, trigram_counts
from ticketloom.workload.tables import bodies, table

FOLDS = 5


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.col("doc_id") % FOLDS != 0)


def _model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    return LanguageModel.of(train_language_model(_labelled(spark, sf_dir)))


def language_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trigram_counts(table(spark, sf_dir, "documents"), "text", "lang")


def trained_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.detect_language(bodies(spark, sf_dir), model=_model(spark, sf_dir)).drop("content")


def trained_language_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages said and detected of the documents that the model was not trained on."""
    held_out = table(spark, sf_dir, "documents").where(F.col("doc_id") % FOLDS == 0)
    found = ops.detect_language(held_out, "text", model=_model(spark, sf_dir))
    return found.groupBy("lang", "detected_language").agg(F.count("*").alias("n_rows"))


_GRAMS = rf"""
    letters AS (
      SELECT doc_id, lang, string_split(' ' || regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]|[\x{{10000}}-\x{{10FFFF}}]', ' ', 'g') || ' ', '') AS c
      FROM documents
    ), grams AS (
      SELECT doc_id, lang, unnest([
        ((unicode(c[i - 1])::BIGINT * {FACTOR} + unicode(c[i])) * {FACTOR} + unicode(c[i + 1])) % {BUCKETS}
        FOR i IN range(2, len(c)) IF c[i] <> ' '])::INT AS bucket
      FROM letters
    )
"""
_ANSWERS = f"""
    {_GRAMS}, taught AS (
      SELECT lang, bucket, count(*) AS n FROM grams WHERE lang IS NOT NULL AND doc_id % {FOLDS} <> 0 GROUP BY lang, bucket
    ), languages AS (
      SELECT lang AS language, count(*) AS texts, sum(count(*)) OVER () AS every
      FROM documents WHERE lang IS NOT NULL AND doc_id % {FOLDS} <> 0 GROUP BY lang
    ), sizes AS (
      SELECT language, texts / every AS share, coalesce(sum(n), 0) + {BUCKETS} AS smoothed
      FROM languages LEFT JOIN taught ON lang = language GROUP BY language, texts, every
    ), weights AS (
      SELECT language, bucket, round(ln((n + 1) / smoothed) * {SCALE})::BIGINT AS weight
      FROM taught JOIN sizes ON language = lang
    ), own AS (
      SELECT doc_id, bucket, count(*) AS n FROM grams GROUP BY doc_id, bucket
    ), scores AS (
      SELECT doc_id, s.language, sum(n) AS n, round(ln(any_value(share)) * {SCALE})::BIGINT
        + sum(n * coalesce(weight, round(ln(1 / smoothed) * {SCALE})::BIGINT)) AS score
      FROM own CROSS JOIN sizes s LEFT JOIN weights w ON w.language = s.language AND w.bucket = own.bucket
      GROUP BY doc_id, s.language
    ), ranked AS (
      SELECT doc_id, language, score - lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC) AS margin,
        row_number() OVER (PARTITION BY doc_id ORDER BY score DESC) AS place
      FROM scores
    ), answers AS (
      SELECT d.doc_id, lang, CASE WHEN margin >= round(ln({ODDS}) * {SCALE}) THEN language ELSE 'unknown' END AS detected_language
      FROM documents d LEFT JOIN ranked r ON r.doc_id = d.doc_id AND place = 1
    )
"""

QUERIES = {
    "language_trigrams": (
        language_trigrams,
        f"""
        WITH {_GRAMS}
        SELECT lang AS language, bucket, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY lang, bucket
        UNION ALL
        SELECT lang, {PRIOR}, count(*) FROM documents WHERE lang IS NOT NULL GROUP BY lang
        """,
    ),
    "trained_language": (trained_language, f"WITH {_ANSWERS} SELECT doc_id, detected_language FROM answers"),
    "trained_language_confusion": (
        trained_language_confusion,
        f"""
        WITH {_ANSWERS}
        SELECT lang, detected_language, count(*) AS n_rows FROM answers WHERE doc_id % {FOLDS} = 0
        GROUP BY lang, detected_language
        """,
    ),
}
