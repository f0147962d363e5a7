"""E-mail content job: CSV in, cleaned and translated CSV out, language statistics."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ticketloom import schemas
from ticketloom.functions import language as lang
from ticketloom.operators import language as ops
from ticketloom.operators.language_model import LanguageModel
from ticketloom.sinks.csv_files import write_csv
from ticketloom.sources.csv_files import read_csv


def process_email_content(
    spark: SparkSession,
    input_csv: str,
    output_path: str,
    schema: T.StructType = schemas.TICKET_EMAIL,
    source: str = lang.SOURCE_LANGUAGE,
    glossary: Mapping[str, str] | None = None,
    provider: lang.Provider | None = None,
    detector: lang.Provider | None = None,
    max_chars: int | None = None,
    batch_size: int | None = None,
    partitions: int | None = None,
    model: LanguageModel | None = None,
    phrases: DataFrame | None = None,
    store: str | None = None,
) -> DataFrame:
    """Clean, detect and translate the ``content`` column and overwrite ``output_path``.

    The result is read back from what was written, so looking at it or counting it
    never repeats a provider's work.
    """
    cleaned = ops.clean_content(read_csv(spark, input_csv, schema, partitions))
    result = ops.translate_content(
        cleaned,
        source=source,
        glossary=glossary,
        provider=provider,
        detector=detector,
        max_chars=max_chars,
        batch_size=batch_size,
        model=model,
        phrases=phrases,
        store=store,
    )
    write_csv(result, output_path, mode="overwrite")
    return read_csv(spark, output_path, result.schema)


class LanguageStatistics(NamedTuple):
    counts: DataFrame
    mentions: DataFrame


def language_statistics(
    translated: DataFrame, language: str = lang.SOURCE_LANGUAGE
) -> LanguageStatistics:
    return LanguageStatistics(
        ops.language_counts(translated), ops.language_mentions(translated, language)
    )
