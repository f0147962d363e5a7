"""Small tables with every awkward row: NULLs, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SYLLABLES = "the an er re on in at nd st es en of te ed or ti hi as to".split()
SCHEMA = (
    "doc_id bigint, text string, lang string, `key` string, id string, `row` string, kept string, "
    "n_words string, `text_print` string, n_lines string, found_id_ string, language string"
)


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def edited(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for k in rng.sample(range(len(words)), min(n, len(words))):
        words[k] = prose(rng, 1) + "x"
    return " ".join(words)


def texts(seed: int = 1) -> dict[int, str | None]:
    """By id: copies, near copies, repeated lines and passages, junk, NULL and empty texts."""
    rng = random.Random(seed)
    base = prose(rng, 160)
    line = prose(rng, 20)
    passage = prose(rng, 60)
    found: dict[int, str | None] = {0: base, 1: base, 2: None, 3: "", 4: " \n\t ", 5: "one", 6: "one", 7: "One two"}
    for k in range(10, 22):
        found[k] = edited(rng, base, rng.randint(1, 14))
    for k in range(30, 36):
        found[k] = f"{prose(rng, 70)}\n{line}\n\n{prose(rng, 30)}\r\n{edited(rng, line, k % 3)}"
    for k in range(40, 44):
        found[k] = f"{prose(rng, 40)} {passage} {prose(rng, 50)}"
    found[50] = "a b c " * 60
    found[51] = " ".join(["same"] * 100)
    found[52] = "*** ### éüñ日本語🙂 " * 20
    found[53] = prose(rng, 9000)
    found[54] = f"{passage} {passage}"
    found[55] = "x" * 5000
    return found


def rows(found: dict[int, str | None]) -> list[tuple]:
    extra = ("k", "i", "r", "y", "w", "p", "l", "f", "g")
    return [(i, t, ("en", "fr", None)[(i or 0) % 3], *extra) for i, t in found.items()]


def table(spark, found):
    return spark.createDataFrame(rows(found), SCHEMA)
