"""API responses landed as JSON files, one response per line.

A malformed response fails the read instead of turning into a row of NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom import schemas
from ticketloom.operators.pages import project_properties


def read_responses(
    spark: SparkSession, path: str, schema: T.StructType, whole_file: bool = False
) -> DataFrame:
    """``whole_file`` reads files that each hold one pretty-printed response."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=whole_file)


def read_ticket_pages(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return read_responses(spark, path, schemas.TICKET_PAGE, whole_file)


def read_association_pages(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return read_responses(spark, path, schemas.ASSOCIATION_PAGE, whole_file)


def read_batch_responses(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return read_responses(spark, path, schemas.BATCH_RESPONSE, whole_file)


def read_emails(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """E-mail objects as a flat table, so that later reads prune the bodies they skip."""
    objects = read_responses(spark, path, schemas.API_OBJECT, whole_file)
    live = objects.where(~F.coalesce(F.col("archived"), F.lit(False)))
    return project_properties(live, schemas.EMAIL_PROPERTIES, default="")
