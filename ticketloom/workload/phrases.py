"""A phrase table made of the beginnings of the source language's documents, looked up in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators.phrases import phrase_matches, phrase_trie, substitute_phrases, words_of
from ticketloom.session import staged
from ticketloom.workload.tables import bodies, table

LENGTHS = (1, 2, 3, 5)
# What a text has up to the end of its fifth word.
_START = rf"^(?:\P{{L}}*\p{{L}}+){{0,{max(LENGTHS)}}}"


def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first words of every document, one, two, three and five of them; common ones have several answers."""
    docs = table(spark, sf_dir, "documents")
    words = words_of(F.regexp_extract("text", _START, 0))
    starts = F.array(*[F.slice(words, 1, n) for n in LENGTHS])
    answer = F.concat(F.lit("<"), F.col("lang"), F.lit("-"), F.col("doc_id").cast("string"), F.lit(">"))
    found = docs.select(answer.alias("answer"), F.explode(starts).alias("start"))
    return found.where(F.size("start") > 0).select(F.array_join("start", " ").alias("phrase"), "answer")


def phrase_substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substitute_phrases(bodies(spark, sf_dir), "content", _phrases(spark, sf_dir), "translated_content").drop("content")


def phrase_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each phrase of several words occurs anywhere, also within longer ones."""
    trie = staged(phrase_trie(_phrases(spark, sf_dir)), "phrase-trie")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = phrase_matches(texts, trie, "doc_id", "text", max(LENGTHS))
    return found.where("n_words > 1").groupBy("answer", "n_words").agg(F.count("*").alias("n_places"))


_NEXT = ", ".join(f"lead(w, {k}) OVER p AS w{k}, lead(gap, {k - 1}) OVER p AS g{k}" for k in range(1, max(LENGTHS)))


def _of_length(n: int) -> str:
    """Places where a phrase of so many words occurs."""
    phrase = " || ' ' || ".join(["w", *(f"w{k}" for k in range(1, n))])
    apart = "".join(f" AND regexp_full_match(g{k}, '\\s+')" for k in range(1, n))
    return f"""SELECT r, pos, n_words, answer FROM following
      JOIN listed ON n_words = {n} AND phrase = {phrase} WHERE true{apart}"""


_MATCHED = rf"""
    texts AS (
      SELECT row_number() OVER () AS r, doc_id, lang, text, regexp_extract_all(lower(text), '\p{{L}}+') AS w,
        regexp_extract_all(text, '\p{{L}}+') AS shown, string_split_regex(text, '\p{{L}}+') AS gaps
      FROM documents
    ), listed AS (
      SELECT array_to_string(w[1:n], ' ') AS phrase, len(w[1:n]) AS n_words, min('<' || lang || '-' || doc_id || '>') AS answer
      FROM texts, (SELECT unnest({list(LENGTHS)}) AS n) WHERE len(w) > 0 GROUP BY 1, 2
    ), places AS (
      SELECT r, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS w, unnest(shown) AS shown, unnest(gaps[2:]) AS gap
      FROM texts
    ), following AS (
      SELECT r, pos, w, {_NEXT} FROM places WINDOW p AS (PARTITION BY r ORDER BY pos)
    ), matches AS (
      {" UNION ALL ".join(_of_length(n) for n in range(1, max(LENGTHS) + 1))}
    )
"""

QUERIES = {
    "phrase_substitution": (
        phrase_substitution,
        f"""
        WITH {_MATCHED}, longest AS (
          SELECT r, pos, max(n_words) AS n_words, arg_max(answer, n_words) AS answer FROM matches GROUP BY r, pos
        ), folded AS (
          -- The first number is where the last one taken ends, the others are the places taken.
          SELECT r, list_reduce(list_prepend([0::BIGINT], list([pos, pos + n_words] ORDER BY pos)), lambda taken, x:
            CASE WHEN x[1] >= taken[1] THEN list_prepend(x[2], list_append(taken[2:], x[1])) ELSE taken END) AS taken
          FROM longest GROUP BY r
        ), taken AS (
          SELECT r, unnest(taken[2:]) AS pos FROM folded
        ), swapped AS (
          SELECT r, pos, n_words, answer FROM longest SEMI JOIN taken USING (r, pos)
        ), covered AS (
          SELECT r, pos AS first, unnest(range(pos, pos + n_words)) AS pos, n_words, answer FROM swapped
        ), pieces AS (
          SELECT p.r, p.pos, CASE WHEN c.first IS NULL THEN shown ELSE '' END
            || CASE WHEN c.first = p.pos THEN c.answer ELSE '' END
            || CASE WHEN c.first IS NULL OR p.pos = c.first + c.n_words - 1 THEN gap ELSE '' END AS piece
          FROM places p LEFT JOIN covered c ON c.r = p.r AND c.pos = p.pos
        ), whole AS (
          SELECT r, string_agg(piece, '' ORDER BY pos) AS rest FROM pieces GROUP BY r
        )
        SELECT doc_id, CASE WHEN rest IS NULL THEN text ELSE gaps[1] || rest END AS translated_content
        FROM texts LEFT JOIN whole USING (r)
        """,
    ),
    "phrase_occurrences": (
        phrase_occurrences,
        f"WITH {_MATCHED} SELECT answer, n_words, count(*) AS n_places FROM matches WHERE n_words > 1 GROUP BY answer, n_words",
    ),
}
