"""Answers of a provider that outlive the job that asked for them.

A store is a folder of Parquet files that is only appended to: the digest of a text and
the provider's answer. Before a provider is asked, what the store knows is left out, so a
rerun, a later run with the same texts and a job that failed half way ask for new texts
only. A text that is in many rows, whatever their partitions, is asked for once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions import language as lang
from ticketloom.operators.joins import join_many_to_one
from ticketloom.session import staged

ANSWERS = "digest binary, answer string"
# So many texts are asked for between two commits: what a failing job loses at most.
TEXTS_PER_COMMIT = 100_000


class Asked(NamedTuple):
    """The rows with their answers, and how many texts were new, answered and failed."""

    rows: DataFrame
    n_new: int
    n_answered: int


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def known_answers(spark: SparkSession, store: str) -> DataFrame:
    """``(digest, answer)`` of everything that was committed; an empty table before the first commit.

    Two jobs that ran at the same time may both have asked for a text: one answer of it counts.
    """
    try:
        found = spark.read.schema(ANSWERS).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ANSWERS)
    return found.groupBy("digest").agg(F.min("answer").alias("answer"))


def new_texts(rows: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """``(digest, text)``: the texts of the rows that have no known answer, once each.

    Digests alone are compared with the store; texts are read again for the new ones only,
    and Spark drops the others' rows by a Bloom filter of the new digests where that pays.
    """
    digest = text_digest(F.col(column))
    wanted = rows.where(F.col(column).isNotNull()).select(digest.alias("digest")).distinct()
    new = staged(wanted.join(known.select("digest"), "digest", "left_anti"), "new-digests")
    texts = rows.where(F.col(column).isNotNull()).select(digest.alias("text_digest"), F.col(column).alias("text"))
    found = join_many_to_one(texts, new, "text_digest", "digest")
    return found.groupBy("digest").agg(F.any_value("text").alias("text"))


def ask_once(
    rows: DataFrame,
    column: str,
    output: str,
    store: str,
    provider: lang.Provider,
    batch_size: int | None = None,
    texts_per_commit: int = TEXTS_PER_COMMIT,
) -> Asked:
    """``rows`` with the provider's answer to ``column`` in ``output``, NULL where it is NULL or failed.

    Texts without a known answer are asked for and their answers appended to ``store``, a
    wave of about ``texts_per_commit`` texts after the other: a job that fails has kept the
    waves before. Failed texts are not stored, so the next run asks for them again. A
    store belongs to one provider: another model, prompt or glossary takes another folder.
    """
    spark = rows.sparkSession
    new = staged(new_texts(rows, column, known_answers(spark, store)), "new-texts")
    n_new = new.count()
    waves = -(-n_new // texts_per_commit)
    for wave in range(waves):
        # The first bits of a digest deal texts to waves, the same ones in every attempt.
        part = F.pmod(F.xxhash64("digest"), F.lit(waves)) == wave
        asked = new.where(part).repartition(F.col("digest")).withColumn("answer", lang.ask_provider(F.col("text"), provider, batch_size))
        asked.where("answer IS NOT NULL").select("digest", "answer").write.mode("append").parquet(store)
    answers = known_answers(spark, store).select(F.col("digest").alias("answered_digest"), F.col("answer").alias(output))
    keyed = rows.withColumn("asked_digest", text_digest(F.col(column)))
    found = join_many_to_one(keyed, answers, "asked_digest", "answered_digest", "left").drop("asked_digest", "answered_digest")
    n_answered = new.join(answers, F.col("digest") == F.col("answered_digest"), "left_semi").count() if n_new else 0
    return Asked(found, n_new, n_answered)
