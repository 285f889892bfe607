"""Relational source: one bounded connection per planned predicate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headgate.plans.splits import RangeSplits

MAX_CONNECTIONS = 10


def range_predicates(splits: RangeSplits) -> list[str]:
    """WHERE clauses of the planned key ranges; together they cover every non-NULL key once."""
    key = f'"{splits.key}"'
    ranges = [f"{key} >= {lo} AND {key} < {hi}" for lo, hi in splits.bounds()]
    return [f"({ranges[0]}) OR {key} IS NULL", *ranges[1:]]


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    splits: RangeSplits | None = None,
    max_connections: int = MAX_CONNECTIONS,
    **options: str,
) -> DataFrame:
    """Read a table over planned key ranges, at most `max_connections` at a time.

    Every range is one partition and one query; columns and filters applied later are pushed
    into it. Without splits the table is read over a single connection.
    """
    properties = {"fetchsize": "10000", **options}
    if splits is None or splits.n == 1:
        return spark.read.jdbc(url, table, properties=properties)
    ranges = spark.read.jdbc(url, table, predicates=range_predicates(splits), properties=properties)
    # Fewer connections than ranges: a task reads several planned ranges, one after the other.
    return ranges.coalesce(max_connections)


def jdbc_stats(spark: SparkSession, url: str, table: str, key: str, **options: str) -> DataFrame:
    """Row count, smallest and largest key, computed by the database."""
    query = f'SELECT COUNT(*) AS row_count, MIN("{key}") AS min_key, MAX("{key}") AS max_key FROM {table}'
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**options).load()
