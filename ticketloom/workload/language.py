"""Cleaning, detection, routing, translation and language statistics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.vocabulary import GERMAN_TO_ENGLISH, STOP_WORDS
from ticketloom.operators import language as ops
from ticketloom.plans.emails import process_email_content as run_process_email_content
from ticketloom.session import shared_path
from ticketloom.sinks.csv_files import write_csv
from ticketloom.workload.tables import bodies, table

# The tables hold no Dutch text; German takes its place.
SOURCE = "German"


def _page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"))


def clean_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_content(_page_bodies(spark, sf_dir))


def truncate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.truncate_content(bodies(spark, sf_dir))


def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.detect_language(bodies(spark, sf_dir)).select("doc_id", "detected_language")


def language_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    detected = ops.detect_language(bodies(spark, sf_dir))
    return ops.route_content(detected, source=SOURCE).drop("content")


def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.language_counts(detect_language(spark, sf_dir))


def ilike_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.language_mentions(detect_language(spark, sf_dir), SOURCE)


def glossary_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.glossary_translate(bodies(spark, sf_dir), source=SOURCE).select(
        "doc_id", "translated_content"
    )


def translate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = ops.clean_content(bodies(spark, sf_dir))
    return ops.translate_content(cleaned, source=SOURCE).drop("content")


def provider_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the provider contract, batch by batch in Python workers."""
    glossary = dict(GERMAN_TO_ENGLISH)

    def word_for_word(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: " ".join(glossary.get(w.lower(), w) for w in t.split(" ")))

    cleaned = ops.clean_content(bodies(spark, sf_dir))
    return ops.translate_content(
        cleaned, source=SOURCE, provider=word_for_word
    ).drop("content")


def _awkward(df: DataFrame, key: str) -> DataFrame:
    """Every body with entities and tags around it; by its number some are NULL, blank or markup alone."""
    kind = F.pmod(F.col(key), F.lit(8))
    wrapped = F.concat(
        F.lit("&nbsp;&lt;i&gt; 1 < 2 &amp;lt;b&amp;gt;\t"), F.col("content"), F.lit("\r\n<br/>&amp;amp; 3 > 2&nbsp;")
    )
    return df.withColumn(
        "content",
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit(" \n\t "))
        .when(kind == 2, F.lit("<p></p>&nbsp;<br>"))
        .otherwise(wrapped),
    )


def clean_awkward_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_content(_awkward(_page_bodies(spark, sf_dir), "page_id"))


def route_awkward_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    detected = ops.detect_language(_awkward(bodies(spark, sf_dir), "doc_id"))
    return ops.route_content(detected, source=SOURCE).drop("content")


def provider_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider that raises for some texts and gives nothing for others: only those become 'error'."""

    def unreliable(texts: pd.Series) -> pd.Series:
        if texts.str.contains("qu", regex=False).any():
            raise ValueError("cannot read this")
        return texts.map(lambda t: None if "nn" in t else t.upper() if t.isascii() else t)

    cleaned = ops.clean_content(bodies(spark, sf_dir))
    return ops.translate_content(cleaned, source=SOURCE, provider=unreliable).drop("content")


def process_email_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV in, cleaned and translated CSV out, read back."""
    emails = _page_bodies(spark, sf_dir).withColumnRenamed("page_id", "ticket_id")
    input_csv = shared_path(spark, "email_bodies")
    write_csv(emails, input_csv)
    schema = T.StructType.fromDDL("ticket_id bigint, content string")
    return run_process_email_content(
        spark,
        input_csv,
        shared_path(spark, "translated_emails"),
        schema=schema,
        source=SOURCE,
    )


def _clean(text: str) -> str:
    sql = f"regexp_replace(coalesce({text}, ''), '<[^>]+>', ' ', 'g')"
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        sql = f"replace({sql}, '{entity}', '{plain}')"
    return rf"trim(regexp_replace(regexp_replace({sql}, '[\r\n\t]+', ' ', 'g'), '\s+', ' ', 'g'))"


def _quoted(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


def _detected(source: str) -> str:
    """``source`` with ``detected_language``; it must give ``id`` and ``content``."""
    scores = ", ".join(
        f"len(list_intersect(present, [{_quoted(words)}])) AS s{i}"
        for i, words in enumerate(STOP_WORDS.values())
    )
    top = f"greatest({', '.join(f's{i}' for i in range(len(STOP_WORDS)))})"
    chosen = " ".join(f"WHEN s{i} = {top} THEN '{name}'" for i, name in enumerate(STOP_WORDS))
    return rf"""
        SELECT id, content, CASE WHEN {top} = 0 THEN 'unknown' {chosen} END AS detected_language
        FROM (SELECT id, content, {scores} FROM (
            SELECT id, content,
                   list_distinct(string_split_regex(lower(content), '[^\p{{L}}]+')) AS present
            FROM ({source})))
    """


def _substituted(text: str) -> str:
    whens = " ".join(f"WHEN '{word}' THEN '{to}'" for word, to in GERMAN_TO_ENGLISH.items())
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        f"lambda w: CASE lower(w) {whens} ELSE w END), ' ')"
    )


_BODIES = "SELECT doc_id AS id, text AS content FROM documents"
_CLEAN_BODIES = f"SELECT doc_id AS id, {_clean('text')} AS content FROM documents"
_CLEAN_PAGES = f"SELECT page_id AS id, {_clean('html')} AS content FROM pages"
_BLANK = "trim(content) = ''"


def _translated(source: str, key: str, keep_content: bool) -> str:
    return f"""
        SELECT id AS {key}, {"content," if keep_content else ""} detected_language,
               CASE WHEN {_BLANK} THEN '' WHEN lower(detected_language) = '{SOURCE.lower()}'
                    THEN {_substituted("content")} ELSE content END AS translated_content
        FROM ({_detected(source)})
    """


def _awkward_sql(table_name: str, key: str, text: str) -> str:
    wrapped = (
        "'&nbsp;&lt;i&gt; 1 < 2 &amp;lt;b&amp;gt;' || chr(9) || "
        f"{text} || chr(13) || chr(10) || '<br/>&amp;amp; 3 > 2&nbsp;'"
    )
    return f"""
        SELECT {key} AS id, CASE {key} % 8 WHEN 0 THEN NULL WHEN 1 THEN ' ' || chr(10) || chr(9) || ' '
               WHEN 2 THEN '<p></p>&nbsp;<br>' ELSE {wrapped} END AS content
        FROM {table_name}
    """


_AWKWARD_BODIES = _awkward_sql("documents", "doc_id", "text")
_FAILED = "(contains(content, 'qu') OR contains(content, 'nn'))"

QUERIES = {
    "clean_awkward_content": (
        clean_awkward_content,
        f"SELECT id AS page_id, {_clean('content')} AS content FROM ({_awkward_sql('pages', 'page_id', 'html')})",
    ),
    "route_awkward_content": (
        route_awkward_content,
        f"""
        SELECT id AS doc_id, detected_language,
               CASE WHEN blank THEN 'skip'
                    WHEN lower(detected_language) = '{SOURCE.lower()}' THEN 'translate'
                    ELSE 'keep' END AS action,
               CASE WHEN blank THEN '' ELSE content END AS kept_content
        FROM (SELECT *, regexp_full_match(coalesce(content, ''), '[\\s]*') AS blank
              FROM ({_detected(f"SELECT id, coalesce(content, '') AS content FROM ({_AWKWARD_BODIES})")}))
        """,
    ),
    "provider_failures": (
        provider_failures,
        f"""
        SELECT id AS doc_id,
               CASE WHEN sent AND {_FAILED} THEN 'error' ELSE detected_language END AS detected_language,
               CASE WHEN {_BLANK} THEN '' WHEN sent AND NOT {_FAILED} AND regexp_full_match(content, '[\\x00-\\x7F]*')
                    THEN upper(content) ELSE content END AS translated_content
        FROM (SELECT *, NOT ({_BLANK}) AND lower(detected_language) = '{SOURCE.lower()}' AS sent
              FROM ({_detected(_CLEAN_BODIES)}))
        """,
    ),
    "clean_content": (
        clean_content,
        f"SELECT page_id, {_clean('html')} AS content FROM pages",
    ),
    "truncate_content": (
        truncate_content,
        """
        SELECT doc_id,
               CASE WHEN length(text) > 1000 THEN left(text, 1000) || '...' ELSE text END AS content
        FROM documents
        """,
    ),
    "detect_language": (
        detect_language,
        f"SELECT id AS doc_id, detected_language FROM ({_detected(_BODIES)})",
    ),
    "language_route": (
        language_route,
        f"""
        SELECT id AS doc_id, detected_language,
               CASE WHEN {_BLANK} THEN 'skip'
                    WHEN lower(detected_language) = '{SOURCE.lower()}' THEN 'translate'
                    ELSE 'keep' END AS action,
               CASE WHEN {_BLANK} THEN ''
                    ELSE content END AS kept_content
        FROM ({_detected(_BODIES)})
        """,
    ),
    "language_counts": (
        language_counts,
        f"""
        SELECT detected_language, count(*) AS n_rows FROM ({_detected(_BODIES)})
        GROUP BY detected_language ORDER BY n_rows DESC, detected_language
        """,
    ),
    "ilike_count": (
        ilike_count,
        f"""
        SELECT count(*) AS n_rows FROM ({_detected(_BODIES)})
        WHERE detected_language ILIKE '%{SOURCE}%'
        """,
    ),
    "glossary_translate": (
        glossary_translate,
        f"""
        SELECT id AS doc_id, {_substituted("content")} AS translated_content
        FROM ({_detected(_BODIES)}) WHERE lower(detected_language) = '{SOURCE.lower()}'
        """,
    ),
    "translate_content": (translate_content, _translated(_CLEAN_BODIES, "doc_id", False)),
    "provider_translate": (provider_translate, _translated(_CLEAN_BODIES, "doc_id", False)),
    "process_email_content": (
        process_email_content,
        _translated(_CLEAN_PAGES, "ticket_id", True),
    ),
}
