"""CSV output as directories of part files.

Paths may carry any scheme the cluster's file systems know (``abfss://``, ``s3a://`` ...).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ticketloom.functions.dates import run_stamp
from ticketloom.sources.csv_files import CSV_OPTIONS, NULL_MARK

# A file with line breaks inside fields cannot be split on reading, so files stay moderate.
MAX_RECORDS_PER_FILE = 200_000


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Header, doubled quotes, and fields written as they are (blanks not trimmed).

    NULL is an absent field, '' a quoted one. In a table of one column an absent field
    would be no line at all, so there NULL is written as ``NULL_MARK``.
    """
    null = NULL_MARK if len(df.columns) == 1 else ""
    (
        df.write.mode(mode)
        .option("nullValue", null)
        .options(**CSV_OPTIONS)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", max_records_per_file)
        .csv(path)
    )


def write_csv_run(df: DataFrame, base: str, moment: dt.datetime | None = None) -> str:
    """One directory per run, named by its time stamp; gives the path."""
    path = f"{base.rstrip('/')}/run={run_stamp(moment)}"
    write_csv(df, path)
    return path
