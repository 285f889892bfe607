"""Join shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.functions.values import exact_sum
from headgate.operators.intervals import interval_join
from headgate.operators.joins import array_member_counts, array_member_join, join_chain, left_chain_counts
from headgate.sources.tables import full_scan


@query(
    "j1_inner_chain",
    """
    SELECT n_name, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
)
def _(spark, sd):
    chain = join_chain(
        full_scan(spark, sd, "lineitem"),
        (full_scan(spark, sd, "orders"), {"l_orderkey": "o_orderkey"}),
        (full_scan(spark, sd, "customer"), {"o_custkey": "c_custkey"}),
        (full_scan(spark, sd, "nation"), {"c_nationkey": "n_nationkey"}),
    )
    return chain.groupBy("n_name").agg(F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("total"))


@query(
    "j2_left_chain",
    """
    SELECT c_custkey, count(DISTINCT o_orderkey) AS children, count(l_orderkey) AS grandchildren
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY c_custkey
    """,
)
def _(spark, sd):
    return left_chain_counts(
        full_scan(spark, sd, "customer"),
        "c_custkey",
        full_scan(spark, sd, "orders"),
        "o_orderkey",
        "o_custkey",
        full_scan(spark, sd, "lineitem"),
        "l_orderkey",
    )


MEMBERS_SQL = "SELECT l_orderkey, l_linenumber, unnest(list_distinct([l_partkey, l_suppkey])) AS k FROM lineitem"


@query(
    "j3_array_member",
    f"SELECT l_orderkey, l_linenumber, p_partkey, p_brand FROM ({MEMBERS_SQL}) JOIN part ON k = p_partkey",
)
def _(spark, sd):
    lineitem = full_scan(spark, sd, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array("l_partkey", "l_suppkey").alias("keys")
    )
    return array_member_join(lineitem, "keys", full_scan(spark, sd, "part").select("p_partkey", "p_brand"), "p_partkey")


@query(
    "j3_array_member_counts",
    f"""
    SELECT p_partkey, p_brand, count(*) AS mentions, min(l_orderkey) AS first_order FROM ({MEMBERS_SQL}) JOIN part ON k = p_partkey
    GROUP BY p_partkey, p_brand
    """,
)
def _(spark, sd):
    lineitem = full_scan(spark, sd, "lineitem").select("l_orderkey", F.array("l_partkey", "l_suppkey").alias("keys"))
    part = full_scan(spark, sd, "part").select("p_partkey", "p_brand")
    return array_member_counts(lineitem, "keys", part, "p_partkey", F.min("l_orderkey").alias("first_order"))


@query(
    "j4_interval_join",
    """
    WITH r AS (SELECT s_suppkey, s_suppkey * 20 AS lo, s_suppkey * 20 + 1 + (s_suppkey * 7) % 50 AS hi FROM supplier)
    SELECT s_suppkey, lo, hi, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem JOIN r ON l_partkey >= lo AND l_partkey < hi GROUP BY s_suppkey, lo, hi
    """,
)
def _(spark, sd):
    lo = F.col("s_suppkey") * 20
    ranges = full_scan(spark, sd, "supplier").select(
        "s_suppkey", lo.alias("lo"), (lo + 1 + (F.col("s_suppkey") * 7) % 50).alias("hi")
    )
    lines = full_scan(spark, sd, "lineitem").select("l_partkey", "l_extendedprice")
    return (
        interval_join(lines, "l_partkey", ranges, "lo", "hi")
        .groupBy("s_suppkey", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("total"))
    )


@query(
    "j4_nested_intervals",
    """
    WITH r AS (
      SELECT n_nationkey, CAST(CASE WHEN n_nationkey % 4 = 0 THEN 1 ELSE n_nationkey * 9 END AS BIGINT) AS lo,
             CAST(CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 5 = 1 THEN n_nationkey * 9 + 1 ELSE 9 * n_nationkey + 40 * n_nationkey * n_nationkey END AS BIGINT) AS hi
      FROM nation
    )
    SELECT n_nationkey, lo, hi, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem JOIN r ON l_partkey >= lo AND (hi IS NULL OR l_partkey < hi) GROUP BY n_nationkey, lo, hi
    """,
)
def _(spark, sd):
    """Open, nested and very wide ranges."""
    n = F.col("n_nationkey")
    lo = F.when(n % 4 == 0, F.lit(1)).otherwise(n * 9)
    hi = F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, n * 9 + 1).otherwise(9 * n + 40 * n * n)
    ranges = full_scan(spark, sd, "nation").select("n_nationkey", lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"))
    lines = full_scan(spark, sd, "lineitem").select("l_partkey", "l_extendedprice")
    return (
        interval_join(lines, "l_partkey", ranges, "lo", "hi")
        .groupBy("n_nationkey", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("total"))
    )
