"""Named tables below a directory."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

FULL_TABLE = "full_table"
CHANGE_STREAM = "change_stream"


class UnknownEntity(LookupError):
    pass


def full_scan(spark: SparkSession, sd: str, entity: str) -> DataFrame:
    """All rows and columns of a named table, columns in source order."""
    try:
        return spark.read.parquet(f"{sd}/{entity}.parquet")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise UnknownEntity(f"unknown entity: {entity}") from None
        raise


def read_entity(
    spark: SparkSession,
    sd: str,
    entity: str,
    mode: str = FULL_TABLE,
    ts: str | None = None,
    cursor: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Read a named table in one of the extraction modes; an unknown mode is an error."""
    from headgate.operators.incremental import incremental

    df = full_scan(spark, sd, entity)
    if mode == FULL_TABLE:
        return df
    if mode == CHANGE_STREAM:
        return incremental(df, ts, cursor, limit)
    raise ValueError(f"unknown extraction mode: {mode}")
