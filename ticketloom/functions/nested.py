"""Access to landed JSON: property bags, result lists and page cursors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def property_value(bag: Column, key: str, default: str | None = None) -> Column:
    """One property of a bag; NULL or ``default`` when the key (or the bag) is absent.

    As with a dictionary lookup, the default replaces a missing key only: a key that
    is present with a null value stays NULL.
    """
    value = bag[key]
    if default is None:
        return value
    present = F.coalesce(F.map_contains_key(bag, key), F.lit(False))
    return F.when(present, value).otherwise(F.lit(default))


def keep_properties(bag: Column, keys: Sequence[str]) -> Column:
    """The bag narrowed to ``keys``."""
    return F.map_filter(bag, lambda key, _value: key.isin(list(keys)))


def items(results: Column) -> Column:
    """A result list, empty when the response carried none."""
    return F.coalesce(results, F.array())


def has_no_items(results: Column) -> Column:
    return F.size(items(results)) == 0


def first_item(results: Column) -> Column:
    """Item 0 or NULL; plain indexing past the end would raise."""
    return F.get(results, 0)


def next_cursor(paging: Column) -> Column:
    """``paging.next.after``; an empty cursor ends the chain just as a missing one does."""
    return F.nullif(paging["next"]["after"], F.lit(""))
