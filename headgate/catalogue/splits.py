"""Statistics, splits and row positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.functions.values import exact_sum
from headgate.operators.scan import union_all
from headgate.plans.rows import numbered, paginate
from headgate.plans.splits import (
    range_splits,
    split_by_hash,
    split_by_range,
    split_by_rows,
    split_count,
)
from headgate.plans.statistics import collect_stats, footer_stats, table_stats
from headgate.sources.tables import full_scan

REPORT_TARGET = 2_000
ORDER = ["o_orderdate", "o_orderkey"]


@query(
    "x1_table_statistics",
    """
    SELECT 'orders' AS entity, count(*) AS row_count, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders
    UNION ALL SELECT 'lineitem', count(*), min(l_orderkey), max(l_orderkey) FROM lineitem
    UNION ALL SELECT 'events', count(*), min(event_id), max(event_id) FROM events
    """,
)
def _(spark, sd):
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}
    return union_all(
        [table_stats(full_scan(spark, sd, t), k).select(F.lit(t).alias("entity"), "*") for t, k in keys.items()]
    )


@query("x1_footer_statistics", "SELECT count(*) AS row_count, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key FROM lineitem")
def _(spark, sd):
    return footer_stats(spark, f"{sd}/lineitem.parquet", "l_orderkey")


@query(
    "x2_range_split",
    """
    WITH b AS (SELECT min(o_orderkey) mn, max(o_orderkey) mx FROM orders)
    SELECT o_orderkey, o_totalprice,
           'split-' || lpad(CAST(least((o_orderkey - mn) // greatest((mx - mn + 1) // 4, 1), 3) AS VARCHAR), 4, '0') AS split_id
    FROM orders, b
    """,
)
def _(spark, sd):
    return split_by_range(full_scan(spark, sd, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 4)


@query(
    "x3_row_index",
    "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders",
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders").select("o_orderkey", "o_orderdate")
    return numbered(orders, ORDER)


@query(
    "x3_row_number_split",
    """
    WITH n AS (SELECT count(*) // 7 AS per FROM orders),
    r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn FROM orders)
    SELECT o_orderkey, 'split-' || lpad(CAST(least(rn // per, 6) AS VARCHAR), 4, '0') AS split_id FROM r, n
    """,
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders").select("o_orderkey", "o_orderdate")
    return split_by_rows(orders, ORDER, 7).drop("o_orderdate")


@query(
    "x4_hash_split",
    """
    SELECT 'split-' || lpad(CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS UBIGINT) % 8 AS VARCHAR), 4, '0') AS split_id,
           count(*) AS row_count, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1
    """,
)
def _(spark, sd):
    tagged = split_by_hash(full_scan(spark, sd, "orders"), "o_orderkey", 8)
    return tagged.groupBy("split_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderkey").alias("min_key"),
        F.max("o_orderkey").alias("max_key"),
        exact_sum(F.col("o_totalprice")).alias("total"),
    )


def planned_report(spark: SparkSession, sd: str, target: int) -> DataFrame:
    """Statistics, split count, ranges, and what each range of orders really holds."""
    orders = full_scan(spark, sd, "orders")
    stats = collect_stats(orders, "o_orderkey")
    n = split_count(stats.row_count, target=target)
    return range_splits(orders, "o_orderkey", n, stats).report(orders, "o_totalprice")


REPORT_SQL = """
    WITH b AS (SELECT min({key}) mn, max({key}) mx, count(*) AS cnt FROM {table}),
    w AS (SELECT *, {n} AS n, greatest((mx - mn + 1) // {n}, 1) AS width FROM b),
    p AS (SELECT CAST(unnest(range(n)) AS BIGINT) AS i, * FROM w),
    a AS (SELECT least(({key} - mn) // width, n - 1) AS i, count(*) AS row_count, min({key}) AS min_key, max({key}) AS max_key,
                 CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE) AS total
          FROM {table}, w GROUP BY 1)
    SELECT 'split-' || lpad(CAST(p.i AS VARCHAR), 4, '0') AS split_id, mn + p.i * width AS lo,
           CASE WHEN p.i = n - 1 THEN mx + 1 ELSE mn + (p.i + 1) * width END AS hi,
           CAST(cnt // n AS BIGINT) AS estimated_rows, coalesce(row_count, 0) AS row_count, min_key, max_key, total
    FROM p LEFT JOIN a ON p.i = a.i
"""


@query(
    "x5_planned_split_report",
    REPORT_SQL.format(
        key="o_orderkey", table="orders", amount="o_totalprice", n="(CASE WHEN cnt <= 2000 THEN 1 ELSE 4 END)"
    ),
)
def _(spark, sd):
    return planned_report(spark, sd, REPORT_TARGET)


@query(
    "x5_split_report",
    REPORT_SQL.format(key="l_orderkey", table="lineitem", amount="l_extendedprice", n="16"),
)
def _(spark, sd):
    lineitem = full_scan(spark, sd, "lineitem")
    return range_splits(lineitem, "l_orderkey", 16).report(lineitem, "l_extendedprice")


@query(
    "i3_paginate",
    """
    WITH r AS (SELECT o_orderkey, o_orderdate, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 4000 AS page FROM orders)
    SELECT page, count(*) AS row_count, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
           arg_min(o_orderkey, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 20, '0')) AS first_key,
           arg_max(o_orderkey, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 20, '0')) AS last_key
    FROM r GROUP BY page
    """,
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders").select("o_orderkey", "o_orderdate")
    edge = F.struct("o_orderdate", "o_orderkey")
    return (
        paginate(orders, ORDER, 4000)
        .groupBy("page")
        .agg(F.count(F.lit(1)).alias("row_count"), F.min(edge).alias("a"), F.max(edge).alias("z"))
        .select(
            "page",
            "row_count",
            F.col("a.o_orderdate").alias("first_date"),
            F.col("z.o_orderdate").alias("last_date"),
            F.col("a.o_orderkey").alias("first_key"),
            F.col("z.o_orderkey").alias("last_key"),
        )
    )
