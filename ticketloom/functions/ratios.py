"""Percentages that give NULL, not an error, over zero rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    share = F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return share if digits is None else F.round(share, digits)
