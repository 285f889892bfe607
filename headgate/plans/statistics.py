"""Table statistics that split plans start from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.session import settings


class NoKeyValues(ValueError):
    """The table has rows, but its key is NULL in all of them."""


@dataclass(frozen=True)
class TableStats:
    row_count: int
    min_key: object
    max_key: object


def table_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: row count, smallest and largest key."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )


#: With these Spark's own reader answers counts and bounds from the footers of parquet files.
FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_stats(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The statistics row of a parquet table from its files' footers, without reading a column.

    Spark pushes the aggregates to the reader where footers have exact bounds of the key (numbers,
    dates, truth values), and scans the key where they have not: text, timestamps, nested values.
    The row is computed at once, as the plan needs settings that hold only meanwhile.
    """
    with settings(spark, FROM_FOOTERS):
        stats = table_stats(spark.read.parquet(path), key)
        found = stats.first()
        # Of a table without rows the reader says nothing, not even that there are none.
        return spark.createDataFrame([(found["row_count"] or 0, found["min_key"], found["max_key"])], stats.schema)


def collect_stats(df: DataFrame, key: str) -> TableStats:
    """The one statistics row on the driver; an all-NULL key is an error."""
    stats = TableStats(*table_stats(df, key).first())
    if stats.row_count > 0 and stats.min_key is None:
        raise NoKeyValues(f"{key} holds no value")
    return stats


def cursor_column(df: DataFrame) -> str:
    """Default column for incremental reads: the first timestamp, else a column named for it."""
    for name, dtype in df.dtypes:
        if dtype in ("timestamp", "timestamp_ntz"):
            return name
    for name in df.columns:
        if name in ("updated_at", "modified_at", "created_at"):
            return name
    raise ValueError("the table has no column that can serve as a cursor")
