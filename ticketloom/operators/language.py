"""Clean, detect, route and translate the text column of a table, and count languages.

Every step is a projection: rows never leave their partition, and none is dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import language as lang
from ticketloom.functions import text as txt
from ticketloom.functions.vocabulary import GLOSSARIES, STOP_WORDS
from ticketloom.operators.answers import ask_once
from ticketloom.operators.language_model import LanguageModel
from ticketloom.operators.phrases import substitute_phrases
from ticketloom.session import staged


def clean_content(df: DataFrame, column: str = "content") -> DataFrame:
    return df.withColumn(column, txt.clean_text(F.col(column)))


def truncate_content(
    df: DataFrame, column: str = "content", max_chars: int | None = txt.MAX_CHARS
) -> DataFrame:
    return df.withColumn(column, txt.truncate_text(F.col(column), max_chars))


def detect_language(
    df: DataFrame,
    column: str = "content",
    stop_words: Mapping[str, Sequence[str]] = STOP_WORDS,
    detector: lang.Provider | None = None,
    batch_size: int | None = None,
    model: LanguageModel | None = None,
) -> DataFrame:
    """Add ``detected_language``; blank text is 'unknown', a failed detector 'error'.

    ``model`` is a trained detector (``train_language_model``) and knows the languages it
    was trained on. Without one, and without a ``detector``, the whole text is scored by the
    stop words that occur in it. All of them read whole texts.
    """
    if model is not None:
        return df.withColumn("detected_language", model.detect(txt.null_to_empty(F.col(column))))
    if detector is None:
        text = txt.null_to_empty(F.col(column))
        return df.withColumn("detected_language", lang.detected_language(text, stop_words))
    blank = txt.is_blank(F.col(column))
    answer = lang.ask_provider(F.when(~blank, F.col(column)), detector, batch_size)
    return (
        df.withColumn("__answer", answer)
        .withColumn(
            "detected_language",
            F.when(blank, F.lit(lang.UNKNOWN)).otherwise(F.coalesce("__answer", F.lit(lang.ERROR))),
        )
        .drop("__answer")
    )


def route_content(
    df: DataFrame,
    column: str = "content",
    source: str = lang.SOURCE_LANGUAGE,
    max_chars: int | None = None,
) -> DataFrame:
    """Add ``action`` (skip, translate or keep) and ``kept_content``: empty for a skipped
    row, else the text, cut to ``max_chars`` if that is given."""
    blank = txt.is_blank(F.col(column))
    return df.withColumns(
        {
            "action": lang.route(F.col("detected_language"), blank, source),
            "kept_content": F.when(blank, F.lit("")).otherwise(
                txt.truncate_text(F.col(column), max_chars)
            ),
        }
    )


def translate_content(
    df: DataFrame,
    column: str = "content",
    source: str = lang.SOURCE_LANGUAGE,
    glossary: Mapping[str, str] | None = None,
    provider: lang.Provider | None = None,
    detector: lang.Provider | None = None,
    max_chars: int | None = None,
    batch_size: int | None = None,
    model: LanguageModel | None = None,
    phrases: DataFrame | None = None,
    store: str | None = None,
) -> DataFrame:
    """Add ``detected_language`` and ``translated_content``.

    Blank text gives ('unknown', ''); the source language its translation; any other
    language the text itself; a failed detection or translation ('error', the text).
    ``max_chars`` cuts texts first. Only rows to be translated reach the provider. Without one,
    the table of ``phrases`` (see ``substitute_phrases``) is looked up if there is one, else
    the source language's glossary is substituted word for word. With a ``store`` (a folder, see
    ``ask_once``) the provider's answers are kept there and never asked for again.
    """
    detected = detect_language(df, column, detector=detector, batch_size=batch_size, model=model)
    routed = route_content(detected, column, source, max_chars)
    asked = F.when(F.col("action") == lang.TRANSLATE, F.col("kept_content"))
    if provider is None and phrases is not None:
        routed = substitute_phrases(routed.withColumn("__asked", asked), "__asked", phrases, "__found").drop("__asked")
        answer = F.col("__found")
    elif provider is not None and store is not None:
        kept = staged(routed.withColumn("__asked", asked), "routed-texts")
        routed = ask_once(kept, "__asked", "__found", store, provider, batch_size).rows.drop("__asked")
        answer = F.col("__found")
    elif provider is not None:
        answer = lang.ask_provider(asked, provider, batch_size)
    else:
        answer = lang.glossary_text(asked, glossary if glossary is not None else GLOSSARIES[source])
    failed = (F.col("action") == lang.TRANSLATE) & F.col("__answer").isNull()
    return (
        routed.withColumn("__answer", answer)
        .withColumns(
            {
                "detected_language": F.when(failed, F.lit(lang.ERROR)).otherwise(
                    F.col("detected_language")
                ),
                "translated_content": F.coalesce("__answer", "kept_content"),
            }
        )
        .drop("__answer", "__found", "action", "kept_content")
    )


def glossary_translate(
    df: DataFrame,
    column: str = "content",
    source: str = lang.SOURCE_LANGUAGE,
    glossary: Mapping[str, str] | None = None,
) -> DataFrame:
    """The rows of the source language, whole texts, substituted word for word.

    The kept rows' language is known, so it is set anew rather than scored again.
    """
    answer = glossary if glossary is not None else GLOSSARIES[source]
    return (
        detect_language(df, column)
        .where(lang.is_language(F.col("detected_language"), source))
        .withColumns(
            {
                "detected_language": F.lit(source),
                "translated_content": lang.glossary_text(F.col(column), answer),
            }
        )
    )


def language_counts(df: DataFrame) -> DataFrame:
    """Rows per detected language, most frequent first."""
    return (
        df.groupBy("detected_language")
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), "detected_language")
    )


def language_mentions(df: DataFrame, language: str = lang.SOURCE_LANGUAGE) -> DataFrame:
    """How many rows' detected language contains a name, whatever the case."""
    named = lang.mentions_language(F.col("detected_language"), language)
    return df.agg(F.count_if(named).alias("n_rows"))
