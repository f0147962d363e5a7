"""A provider with a store of answers, asked for the documents in several runs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators.answers import ask_once
from ticketloom.session import shared_path
from ticketloom.workload.tables import bodies, table

FIRST_RUN = "src2"


def _unreliable(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if "qu" in t else t.upper() if t.isascii() else t)


def stored_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two runs: its answers come from the store, but for the failed ones."""
    store, texts = shared_path(spark, "answers"), bodies(spark, sf_dir)
    ask_once(texts, "content", "answer", store, _unreliable)
    return ask_once(texts, "content", "answer", store, _unreliable).rows.drop("content")


def answer_store_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs asked for: some sources, all of them, and all of them once more."""
    store, docs = shared_path(spark, "answers"), table(spark, sf_dir, "documents").select("text", "source")
    runs = [docs.where(F.col("source") < FIRST_RUN), docs, docs]
    found = [ask_once(rows, "text", "answer", store, _unreliable) for rows in runs]
    counts = [(k, asked.n_new, asked.n_answered) for k, asked in enumerate(found, 1)]
    return spark.createDataFrame(counts, "run int, n_new bigint, n_answered bigint")


QUERIES = {
    "stored_answers": (
        stored_answers,
        """
        SELECT doc_id, CASE WHEN contains(text, 'qu') THEN NULL
          WHEN regexp_full_match(text, '[\\x00-\\x7F]*') THEN upper(text) ELSE text END AS answer
        FROM documents
        """,
    ),
    "answer_store_runs": (
        answer_store_runs,
        f"""
        WITH texts AS (
          SELECT text, contains(text, 'qu') AS fails, bool_or(coalesce(source < '{FIRST_RUN}', false)) AS early
          FROM documents WHERE text IS NOT NULL GROUP BY text
        )
        SELECT 1 AS run, count(*) FILTER (early) AS n_new, count(*) FILTER (early AND NOT fails) AS n_answered FROM texts
        UNION ALL
        SELECT 2, count(*) FILTER (NOT early OR fails), count(*) FILTER (NOT early AND NOT fails) FROM texts
        UNION ALL
        SELECT 3, count(*) FILTER (fails), 0 FROM texts
        """,
    ),
}
