"""Search-index reads (SRC9): any Spark data source, predicate pushed down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks.documents import lower_columns


def read_index(spark: SparkSession, name: str, predicate: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Documents of index `name` that satisfy `predicate` (SQL text), with
    lower-case column names. Both arguments must be non-empty."""
    if not name or not predicate:
        raise ValueError("index name and predicate must be non-empty")
    df = spark.read.format(fmt).options(**(options or {})).load(name)
    return lower_columns(df.where(predicate))
