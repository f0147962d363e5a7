"""Newly landed responses flattened as they arrive.

Flattening and cleaning keep no state, so the batch operators run unchanged on a stream;
each run picks up the files landed since the last one and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ticketloom import schemas
from ticketloom.operators import pages


def stream_tickets(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Tickets of the pages in ``path``, at most ``max_files`` pages' files per batch."""
    landed = (
        spark.readStream.schema(schemas.TICKET_PAGE)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )
    return pages.project_properties(
        pages.flatten_ticket_pages(landed), schemas.TICKET_PROPERTIES
    )


def append_available(df: DataFrame, table_path: str, progress_path: str) -> StreamingQuery:
    """Append everything that is new to a parquet table, exactly once, then stop."""
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start(table_path)
    )
