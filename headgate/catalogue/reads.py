"""Scans, projections, predicates, ordering, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.functions.values import blank_to_null, extension, has_extension
from headgate.operators.envelope import extract, to_cells, to_envelope
from headgate.operators.scan import (
    after_cursor,
    below_path,
    first_by,
    first_per_group,
    in_range,
    project,
    tag_hash,
    read_range,
    union_all,
)
from headgate.plans.rows import page, plan_rows
from headgate.plans.splits import range_splits, row_split_bounds
from headgate.session import workspace
from headgate.sources.listing import MODEL_EXTENSIONS
from headgate.sources.tables import full_scan

SPLITS = 4
RANGE_INDEX = (
    "least((o_orderkey - mn) // greatest((mx - mn + 1) // 4, 1), 3) "
)


@query("s1_full_scan", "SELECT * FROM orders")
def _(spark, sd):
    return full_scan(spark, sd, "orders")


@query("s2_offset_page", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000 OFFSET 5000")
def _(spark, sd):
    return page(full_scan(spark, sd, "orders"), "o_orderkey", "5000")


@query(
    "s3_range_split_scan",
    f"""
    WITH b AS (SELECT min(o_orderkey) mn, max(o_orderkey) mx FROM orders)
    SELECT CAST({RANGE_INDEX} AS INTEGER) AS split_index, o_orderkey, o_totalprice FROM orders, b
    """,
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders")
    bounds = range_splits(orders, "o_orderkey", SPLITS).bounds()
    return union_all(
        [
            read_range(orders, "o_orderkey", lo, hi, ["o_totalprice", "o_orderkey"], nulls=i == 0).select(
                F.lit(i).alias("split_index"), "*"
            )
            for i, (lo, hi) in enumerate(bounds)
        ]
    )


@query(
    "s4_row_number_split_scan",
    """
    WITH n AS (SELECT count(*) // 4 AS per FROM orders),
    r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn FROM orders)
    SELECT CAST(least(rn // per, 3) AS INTEGER) AS split_index, o_orderkey, o_orderdate, o_totalprice FROM r, n
    """,
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    plan = plan_rows(orders, ["o_orderdate", "o_orderkey"])
    parts = plan.slices(orders, row_split_bounds(plan.total, SPLITS))
    return union_all([p.withColumn("split_index", F.lit(i)) for i, p in enumerate(parts)])


@query(
    "s5_hash_split_scan",
    """
    SELECT CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS UBIGINT) % 4 AS INTEGER) AS split_index,
           o_orderkey, o_totalprice
    FROM orders
    """,
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders").select("o_orderkey", "o_totalprice")
    return tag_hash(orders, "o_orderkey", SPLITS)


@query("s9_envelope", "SELECT 'orders' AS entity, 'UPSERT' AS op, * FROM orders")
def _(spark, sd):
    return to_envelope(full_scan(spark, sd, "orders"), "orders").select("entity", "op", "data.*")


@query(
    "s9_cells",
    """
    WITH c AS (
      SELECT CAST(c_custkey AS VARCHAR) AS key, 'c_custkey' AS "column", 'Int64Val' AS kind, CAST(c_custkey AS VARCHAR) AS value FROM customer
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_name', 'StringVal', c_name FROM customer
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_nationkey', 'Int32Val', CAST(c_nationkey AS VARCHAR) FROM customer
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_acctbal', 'DoubleVal', CAST(c_acctbal AS VARCHAR) FROM customer
      UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_mktsegment', 'StringVal', c_mktsegment FROM customer)
    SELECT 'customer' AS entity, 'UPSERT' AS op, key, "column",
           CASE WHEN value IS NULL THEN 'NullVal' ELSE kind END AS kind, value FROM c
    """,
)
def _(spark, sd):
    return to_cells(full_scan(spark, sd, "customer"), "customer", "c_custkey")


EXTRACT_AS_OF = "2024-02-01 00:00:00"


@query(
    "s10_extract_state",
    """
    WITH s AS (SELECT count(*) AS records, max(ts) AS mts, arg_max(event_id, ts) AS last_key FROM events)
    SELECT 'events' AS entity,
           replace(replace(to_base64(encode('{"type":"timestamp","position":{"timestamp":"' || strftime(mts, '%Y-%m-%dT%H:%M:%S.%fZ')
             || '","last_id":"' || last_key || '"},"timestamp":"2024-02-01T00:00:00.000000Z"}')), '+', '-'), '/', '_') AS token,
           epoch_us(mts) AS watermark, 'all' AS group_id, records, last_key
    FROM s
    """,
)
def _(spark, sd):
    events = full_scan(spark, sd, "events")
    path = workspace(spark, "extract")
    return extract(events, path, "events", "event_id", EXTRACT_AS_OF, "ts")[1]


@query(
    "s10_extract_offset_state",
    """
    WITH s AS (SELECT count(*) AS records, max(p_partkey) AS last_key FROM part)
    SELECT 'part' AS entity,
           replace(replace(to_base64(encode('{"type":"offset","position":{"offset":' || records
             || '},"timestamp":"2024-02-01T00:00:00.000000Z"}')), '+', '-'), '/', '_') AS token,
           NULL::BIGINT AS watermark, 'all' AS group_id, records, last_key
    FROM s
    """,
)
def _(spark, sd):
    part = full_scan(spark, sd, "part")
    return extract(part, workspace(spark, "extract"), "part", "p_partkey", EXTRACT_AS_OF)[1]


@query("s10_extract_rows", "SELECT * FROM events")
def _(spark, sd):
    events = full_scan(spark, sd, "events")
    path = workspace(spark, "extract")
    return extract(events, path, "events", "event_id", EXTRACT_AS_OF, "ts")[0]


@query("p1_project", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sd):
    return project(full_scan(spark, sd, "orders"), ["o_totalprice", "no_such_column", "o_orderkey"])


@query("p2_cursor_predicate", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def _(spark, sd):
    return full_scan(spark, sd, "events").where(after_cursor("ts", "2024-01-15 00:00:00"))


@query(
    "p3_range_predicate",
    "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01'",
)
def _(spark, sd):
    month = [F.lit(d).cast("timestamp_ntz") for d in ("1997-03-01", "1997-04-01")]
    return full_scan(spark, sd, "lineitem").where(in_range("l_shipdate", *month))


@query(
    "p4_extension_filter",
    """
    WITH f AS (SELECT p_partkey, 'models/part-' || p_partkey || '.' ||
                 CASE p_size % 4 WHEN 0 THEN 'step' WHEN 1 THEN 'STP' WHEN 2 THEN 'pdf' ELSE 'Step.bak' END AS path FROM part)
    SELECT p_partkey, path FROM f WHERE lower(path) LIKE '%.step' OR lower(path) LIKE '%.stp'
    """,
)
def _(spark, sd):
    part = full_scan(spark, sd, "part")
    kinds = F.array(*[F.lit(e) for e in ("step", "STP", "pdf", "Step.bak")])
    path = F.concat(F.lit("models/part-"), F.col("p_partkey"), F.lit("."), F.get(kinds, F.col("p_size") % 4))
    return part.select("p_partkey", path.alias("path")).where(has_extension(extension(F.col("path")), MODEL_EXTENSIONS))


@query("p5_blank_to_null", "SELECT page_id, NULLIF(TRIM(regexp_extract(url, '#(.*)$', 1)), '') AS fragment FROM pages")
def _(spark, sd):
    fragment = F.regexp_extract("url", "#(.*)$", 1)
    return full_scan(spark, sd, "pages").select("page_id", blank_to_null(fragment).alias("fragment"))


@query("p6_prefix_filter", "SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')")
def _(spark, sd):
    return full_scan(spark, sd, "pages").where(below_path("url", "https://")).select("page_id", "url")


@query("o1_top_by_cursor", "SELECT * FROM events ORDER BY ts LIMIT 100")
def _(spark, sd):
    return first_by(full_scan(spark, sd, "events"), ["ts"], 100)


@query(
    "o2_first_per_group",
    "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
)
def _(spark, sd):
    return first_per_group(full_scan(spark, sd, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("o3_union_of_splits", "SELECT *, nullif(o_orderkey % 7, 0) AS k FROM orders")
def _(spark, sd):
    """Splits of a column in which keys repeat and are missing."""
    orders = full_scan(spark, sd, "orders").withColumn("k", F.nullif(F.col("o_orderkey") % 7, F.lit(0)))
    bounds = range_splits(orders, "k", SPLITS).bounds()
    return union_all([read_range(orders, "k", lo, hi, nulls=i == 0) for i, (lo, hi) in enumerate(bounds)])
