"""Rolling date windows and run stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "%Y%m%d_%H%M%S"
SPARK_STAMP_FORMAT = "yyyyMMdd_HHmmss"
SPARK_DATE_FORMAT = "yyyy-MM-dd"


def as_of_date(as_of: dt.date | str | Column | None) -> Column:
    """The day a window ends: a given day, or the session's current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def in_last_days(moment: Column, days: int, as_of: dt.date | str | Column | None = None) -> Column:
    """``date(moment) >= as_of - days``; Spark turns it into a pushed range on the column."""
    return F.to_date(moment) >= F.date_sub(as_of_date(as_of), days)


def on_or_after(moment: Column, cutoff: str) -> Column:
    """``date(moment) >= cutoff`` for a cutoff written ``YYYY-MM-DD``."""
    return F.to_date(moment) >= F.lit(cutoff).cast("date")


def cutoff_text(days: int, as_of: dt.date | None = None) -> str:
    """The cutoff day as text, for callers that keep it as a string literal."""
    return ((as_of or dt.date.today()) - dt.timedelta(days=days)).isoformat()


def run_stamp(moment: dt.datetime | None = None) -> str:
    return (moment or dt.datetime.now()).strftime(STAMP_FORMAT)


def date_text(moment: Column) -> Column:
    return F.date_format(moment, SPARK_DATE_FORMAT)


def stamp_text(moment: Column) -> Column:
    return F.date_format(moment, SPARK_STAMP_FORMAT)
