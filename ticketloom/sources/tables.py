"""Warehouse tables, by path or by catalog name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, location: str, fmt: str = "parquet", columns: Sequence[str] | None = None
) -> DataFrame:
    """A table at a path in some file format, or a catalog table with ``fmt='table'``."""
    df = spark.table(location) if fmt == "table" else spark.read.format(fmt).load(location)
    return df.select(*columns) if columns else df
