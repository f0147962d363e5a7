"""E-mail text clean-up as nested built-in expressions (one projection, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The entities that are decoded, in the order they are decoded.
# '&amp;' precedes '&lt;', so a doubly escaped tag survives as visible text.
ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
)
# Patterns, and how long text is cut.
TAG = "<[^>]+>"
WHITESPACE = r"\s+"
MAX_CHARS = 1000
ELLIPSIS = "..."

# Unicode-aware and with the information separators: what a string strip would remove,
# so a body holding only no-break spaces counts as blank.
BLANK = r"(?U)^[\s\x1C-\x1F]*$"


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip_tags(text: Column) -> Column:
    """Tags become a space. Plain comparisons such as ``1 < 2 and 3 > 2`` match too."""
    return F.regexp_replace(text, TAG, " ")


def decode_entities(text: Column) -> Column:
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def collapse_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, WHITESPACE, " ")


def clean_text(text: Column) -> Column:
    """The whole clean-up chain, tags before entities before whitespace.

    CR, LF and TAB are whitespace, so collapsing whitespace runs already gives what
    collapsing line breaks first would give; that regex pass over the text is saved.
    """
    return F.trim(collapse_whitespace(decode_entities(strip_tags(null_to_empty(text)))))


def is_blank(text: Column) -> Column:
    return null_to_empty(text).rlike(BLANK)


def truncate_text(text: Column, max_chars: int | None = MAX_CHARS) -> Column:
    """Cut to ``max_chars`` code points and mark the cut; ``None`` keeps the text whole."""
    if max_chars is None:
        return text
    cut = F.concat(F.substring(text, 1, max_chars), F.lit(ELLIPSIS))
    return F.when(F.length(text) > max_chars, cut).otherwise(text)


def display_text(text: Column, width: int = 50) -> Column:
    """Fit into ``width`` characters the way a truncated table preview does."""
    cut = F.concat(F.substring(text, 1, width - len(ELLIPSIS)), F.lit(ELLIPSIS))
    return F.when(F.length(text) > width, cut).otherwise(text)


def same_text(left: Column, right: Column) -> Column:
    """Equality that is never NULL: a missing side is a mismatch, even against another."""
    return F.coalesce(left == right, F.lit(False))
