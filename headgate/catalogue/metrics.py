"""Counts, metrics, quality and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.operators.aggregates import (
    active_gauge,
    counters,
    entity_counts,
    histogram,
    ordered_text,
    ordered_text_parts,
    throughput,
)
from headgate.operators.envelope import observed_extract
from headgate.operators.quality import Rule, quality_events, quality_summary, threshold_check
from headgate.operators.schema import fallback_report
from headgate.session import workspace
from headgate.sources.tables import full_scan

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
BOUNDS = [1, 5, 10, 30, 60, 300]
CENTS_SQL = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)"


@query(
    "a1_entity_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS entity, count(*) AS row_count FROM {t}" for t in TABLES),
)
def _(spark, sd):
    return entity_counts({t: full_scan(spark, sd, t) for t in TABLES})


@query(
    "a2_ordered_text",
    "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS nations FROM nation GROUP BY n_regionkey",
)
def _(spark, sd):
    return ordered_text(full_scan(spark, sd, "nation"), ["n_regionkey"], "n_name", "n_name", "nations")


@query(
    "a2_ordered_text_parts",
    """
    WITH r AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_orderkey) - 1 AS pos FROM orders)
    SELECT o_orderpriority, pos // 500 AS part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY pos) AS orders FROM r GROUP BY 1, 2
    """,
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    return ordered_text_parts(orders, ["o_orderpriority"], "o_orderkey", ["o_orderdate", "o_orderkey"], "orders", 500)


@query(
    "a3_counters",
    """
    SELECT event_type, user_id, count(*) AS records, CAST(sum(strlen(props)) AS BIGINT) AS bytes,
           count(*) FILTER (WHERE value > 100) AS errors
    FROM events GROUP BY event_type, user_id
    """,
)
def _(spark, sd):
    events = full_scan(spark, sd, "events")
    return counters(events, ["event_type", "user_id"], F.octet_length("props"), F.col("value") > 100)


@query(
    "a4_duration_histogram",
    f"""
    WITH b AS (SELECT unnest([{", ".join(str(b) for b in BOUNDS)}]) AS bound),
    s AS (SELECT event_type, {CENTS_SQL} AS sum, count(*) AS count FROM events GROUP BY event_type)
    SELECT s.event_type, sum, count, CAST(bound AS VARCHAR) AS le,
           (SELECT count(*) FROM events e WHERE e.event_type = s.event_type AND e.value <= bound) AS bucket
    FROM s, b
    UNION ALL SELECT event_type, sum, count, '+Inf', count FROM s
    """,
)
def _(spark, sd):
    return histogram(full_scan(spark, sd, "events"), ["event_type"], "value", BOUNDS)


@query(
    "a5_active_gauge",
    """
    SELECT user_id, CAST(sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END) AS BIGINT) AS active
    FROM events GROUP BY user_id
    """,
)
def _(spark, sd):
    kind = F.col("event_type")
    return active_gauge(full_scan(spark, sd, "events"), ["user_id"], kind == "signup", kind == "error")


@query(
    "a6_throughput",
    """
    SELECT event_type, count(*) AS records, CAST(sum(strlen(props)) AS BIGINT) AS bytes,
           round(count(*) / nullif(date_diff('microsecond', min(ts), max(ts)), 0) * 1e6, 6) AS records_per_second
    FROM events GROUP BY event_type
    """,
)
def _(spark, sd):
    return throughput(full_scan(spark, sd, "events"), ["event_type"], "ts", F.octet_length("props"))


def document_rules() -> list[Rule]:
    return [
        Rule("short text", "info", F.length("text") < 300),
        Rule("length differs from n_chars", "error", F.length("text") != F.col("n_chars")),
        Rule("replacement character", "warning", F.contains("text", F.lit("�"))),
    ]


def event_rules() -> list[Rule]:
    return [
        Rule("value above limit", "warning", F.col("value") > 200),
        Rule("failed call", "error", F.col("event_type") == "error"),
    ]


FINDINGS_SQL = """
    SELECT 'documents' AS entity, CAST(doc_id AS VARCHAR) AS key, 'short text' AS issue, 'info' AS severity FROM documents WHERE length(text) < 300
    UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), 'length differs from n_chars', 'error' FROM documents WHERE length(text) <> n_chars
    UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), 'replacement character', 'warning' FROM documents WHERE contains(text, chr(65533))
    UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), 'value above limit', 'warning' FROM events WHERE value > 200
    UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), 'failed call', 'error' FROM events WHERE event_type = 'error'
"""


def all_findings(spark, sd):
    return [
        quality_events(full_scan(spark, sd, "documents"), "documents", "doc_id", document_rules()),
        quality_events(full_scan(spark, sd, "events"), "events", "event_id", event_rules()),
    ]


@query("m1_quality_events", FINDINGS_SQL)
def _(spark, sd):
    documents, events = all_findings(spark, sd)
    return documents.unionByName(events)


@query(
    "m1_quality_summary",
    f"SELECT entity, issue, severity, count(*) AS findings FROM ({FINDINGS_SQL}) GROUP BY ALL",
)
def _(spark, sd):
    return quality_summary(all_findings(spark, sd))


@query(
    "m2_type_fallbacks",
    r"""
    SELECT 'o_orderpriority' AS "column", 'int' AS declared, count(o_orderpriority) AS cells,
           count(*) FILTER (WHERE NOT regexp_full_match(o_orderpriority, '[+-]?\d+')) AS fallbacks FROM orders
    UNION ALL SELECT 'o_orderkey', 'smallint', count(o_orderkey), count(*) FILTER (WHERE o_orderkey > 32767) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'boolean', count(o_orderstatus),
           count(*) FILTER (WHERE lower(o_orderstatus) NOT IN ('t','true','y','yes','1','f','false','n','no','0')) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice), 0 FROM orders
    """,
)
def _(spark, sd):
    declared = {"o_orderpriority": "int", "o_orderkey": "smallint", "o_orderstatus": "boolean", "o_totalprice": "double"}
    return fallback_report(full_scan(spark, sd, "orders"), declared)


@query(
    "m3_run_thresholds",
    """
    WITH r AS (SELECT event_type, count(*) AS records, date_diff('microsecond', TIMESTAMP '2024-01-01', min(ts)) / 1e6 AS first_record_seconds,
                 round(count(*) / nullif(date_diff('microsecond', min(ts), max(ts)) / 1e6, 0), 6) AS records_per_second
               FROM events GROUP BY event_type)
    SELECT *, coalesce(records_per_second >= 0.0008, true) AS rate_ok, first_record_seconds <= 300 AS first_record_ok,
           records <= 2000 AS records_ok
    FROM r
    """,
)
def _(spark, sd):
    return threshold_check(full_scan(spark, sd, "events"), ["event_type"], "ts", "2024-01-01", 0.0008, 300, 2000)


@query("a6_observed", "SELECT count(*) AS records, CAST(sum(strlen(props)) AS BIGINT) AS bytes, max(ts) AS watermark FROM events")
def _(spark, sd):
    events = full_scan(spark, sd, "events")
    return observed_extract(events, workspace(spark, "observed"), F.octet_length("props"), "ts")
