from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from ticketloom.functions import text as txt


def apply(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")
    rows = df.select("i", function(F.col("content")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        (None, ""),
        ("", ""),
        ("   \t\n ", ""),
        ("<p>Hi<br/>there</p>", "Hi there"),
        ("a&nbsp;b &amp; c &lt;d&gt;", "a b & c <d>"),
        ("&amp;lt;b&amp;gt;", "<b>"),
        ("&lt;b&gt;x", "<b>x"),
        ("1 < 2 and 3 > 2", "1 2"),
        ("line1\r\n\r\nline2\tend", "line1 line2 end"),
        ("<a\nhref='x'>multi\nline tag</a>", "multi line tag"),
        ("<>kept", "<>kept"),
    ],
)
def test_clean(spark, body, expected):
    assert apply(spark, txt.clean_text, [body]) == [expected]


def test_no_break_space_stays_and_vertical_tab_collapses(spark):
    assert apply(spark, txt.clean_text, ["a\u00a0b \u000bc"]) == ["a\u00a0b c"]


def stepwise_clean(body):
    """The chain step by step, line breaks collapsed before other whitespace."""
    body = re.sub("<[^>]+>", " ", body)
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        body = body.replace(entity, plain)
    body = re.sub("[\r\n\t]+", " ", body)
    return re.sub("[ \t\n\x0b\f\r]+", " ", body).strip(" ")


def random_bodies(n=2000):
    pieces = ["<b>", "</b>", "<", ">", "&nbsp;", "&amp;", "&lt;", "&gt;", "amp;", "&"]
    pieces += [" ", "  ", "\n", "\r\n", "\t", "\f", "é", "ü", "word", "1", "\u00a0", "lt;", "😀"]
    rng = random.Random(7)
    return ["".join(rng.choices(pieces, k=rng.randrange(0, 25))) for _ in range(n)]


def test_clean_equals_step_by_step_chain(spark):
    bodies = random_bodies()
    assert apply(spark, txt.clean_text, bodies) == [stepwise_clean(b) for b in bodies]




def test_blank_is_what_strip_empties(spark):
    texts = [None, "", "  ", "\u00a0", "\t\n", "\x1c", "x", "\u00a0x ", " \nx"]
    blank = apply(spark, txt.is_blank, texts)
    assert blank == [not (t or "").strip() for t in texts] == [True] * 6 + [False] * 3


def test_truncate(spark):
    texts = ["x" * 1000, "x" * 1001, "é" * 1001, "😀" * 1001, None]
    out = apply(spark, txt.truncate_text, texts)
    assert out == ["x" * 1000, "x" * 1000 + "...", "é" * 1000 + "...", "😀" * 1000 + "...", None]
    whole = apply(spark, lambda c: txt.truncate_text(c, None), ["x" * 5000])
    assert whole == ["x" * 5000]


def test_display(spark):
    assert apply(spark, txt.display_text, ["y" * 50, "y" * 51]) == ["y" * 50, "y" * 47 + "..."]


def test_same_text_is_never_null(spark):
    df = spark.createDataFrame([(None, None), ("a", "a"), ("b", None)], "x string, y string")
    out = [r.m for r in df.select(txt.same_text(F.col("x"), F.col("y")).alias("m")).collect()]
    assert out == [False, True, False]
