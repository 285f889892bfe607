"""Incremental reads, resumption, checkpoint logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.functions.tokens import encode_token, lsn_number, rfc3339
from headgate.operators.incremental import (
    after_lsn,
    decode_checkpoints,
    incremental,
    latest_checkpoints,
    read_from,
    resume,
    stale_checkpoints,
)
from headgate.operators.scan import union_all
from headgate.sources.tables import full_scan

LSN_STEP = 1 << 24
LOG_POSITION = "(event_id * 16777216)"
LSN_SQL = f"to_hex({LOG_POSITION} // 4294967296) || '/' || to_hex({LOG_POSITION} % 4294967296)"
ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


def with_lsn(events: DataFrame) -> DataFrame:
    at = F.col("event_id") * F.lit(LSN_STEP)
    hi, lo = F.shiftright(at, 32), at.bitwiseAND(F.lit((1 << 32) - 1))
    return events.withColumn("lsn", F.concat_ws("/", F.hex(hi), F.hex(lo)))


def checkpoint_log(spark: SparkSession, sd: str) -> DataFrame:
    """One checkpoint per event, its type by turns, its creation time the event's."""
    events = with_lsn(full_scan(spark, sd, "events"))
    turn = F.col("event_id") % 4
    kind = F.get(F.array(*[F.lit(k) for k in ("offset", "timestamp", "lsn", "subgraph")]), turn.cast("int"))
    offset = F.struct(F.col("event_id").alias("offset"), F.lit(1000).cast("bigint").alias("limit"))
    stamp = F.struct(rfc3339(F.col("ts")).alias("timestamp"), F.col("user_id").cast("string").alias("last_id"))
    lsn = F.struct("lsn", F.lit("shop").alias("database"))
    graph = F.struct((F.col("user_id") % 5).cast("int").alias("current_depth"))
    token = (
        F.when(turn == 0, encode_token(kind, offset, F.col("ts")))
        .when(turn == 1, encode_token(kind, stamp, F.col("ts")))
        .when(turn == 2, encode_token(kind, lsn, F.col("ts")))
        .otherwise(encode_token(kind, graph, F.col("ts")))
    )
    return events.select("event_id", "ts", "user_id", "event_type", "lsn", kind.alias("kind"), token.alias("token"))


TOKEN_BODY_SQL = f"""
    '{{"type":"' || CASE event_id % 4 WHEN 0 THEN 'offset' WHEN 1 THEN 'timestamp' WHEN 2 THEN 'lsn' ELSE 'subgraph' END
    || '","position":{{' || CASE event_id % 4
        WHEN 0 THEN '"offset":' || event_id || ',"limit":1000'
        WHEN 1 THEN '"timestamp":"' || {ISO_SQL} || '","last_id":"' || user_id || '"'
        WHEN 2 THEN '"lsn":"' || {LSN_SQL} || '","database":"shop"'
        ELSE '"current_depth":' || (user_id % 5) END
    || '}},"timestamp":"' || {ISO_SQL} || '"}}'
"""


@query(
    "i1_incremental",
    "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 12:00:00' ORDER BY ts LIMIT 500",
)
def _(spark, sd):
    return incremental(full_scan(spark, sd, "events"), None, "2024-01-10 12:00:00", 500)


@query(
    "i2_keyset_resume",
    """
    SELECT * FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-05', 700)
    ORDER BY o_orderdate, o_orderkey LIMIT 1000
    """,
)
def _(spark, sd):
    return resume(full_scan(spark, sd, "orders"), "o_orderdate", "o_orderkey", "1998-01-05", 700, 1000)


@query(
    "i4_after_log_position",
    f"""
    SELECT event_id, {LSN_SQL} AS lsn, CAST({LOG_POSITION} AS DECIMAL(20,0)) AS position
    FROM events WHERE {LOG_POSITION} > 2 * 4294967296 + 167772160
    """,
)
def _(spark, sd):
    log = with_lsn(full_scan(spark, sd, "events").select("event_id"))
    return after_lsn(log, "lsn", "2/A000000").withColumn("position", lsn_number(F.col("lsn")))


@query(
    "i5_encode_checkpoints",
    f"SELECT event_id, replace(replace(to_base64(encode({TOKEN_BODY_SQL})), '+', '-'), '/', '_') AS token FROM events",
)
def _(spark, sd):
    return checkpoint_log(spark, sd).select("event_id", "token")


@query(
    "i5_read_from_token",
    f"""
    SELECT 'offset' AS kind, o_orderkey AS key FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 250 OFFSET 777)
    UNION ALL SELECT 'timestamp', o_orderkey FROM
      (SELECT o_orderkey FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-05', 700) ORDER BY o_orderdate, o_orderkey LIMIT 400)
    UNION ALL SELECT 'lsn', event_id FROM (SELECT event_id FROM events WHERE {LOG_POSITION} > 2 * 4294967296 + 167772160 ORDER BY {LOG_POSITION} LIMIT 400)
    """,
)
def _(spark, sd):
    """Pages after tokens of three kinds, each told by the token alone."""
    orders, log = full_scan(spark, sd, "orders"), with_lsn(full_scan(spark, sd, "events"))
    at = F.struct(rfc3339(F.lit("1998-01-05").cast("timestamp_ntz")).alias("timestamp"), F.lit("700").alias("last_id"))
    tokens = {
        "offset": F.struct(F.lit(777).alias("offset"), F.lit(250).alias("limit")),
        "timestamp": at,
        "lsn": F.struct(F.lit("2/A000000").alias("lsn"), F.lit("shop").alias("database")),
    }
    parts = []
    for kind, position in tokens.items():
        created = F.lit("2024-02-01").cast("timestamp_ntz")
        token = spark.range(1).select(encode_token(F.lit(kind), position, created)).first()[0]
        table, key = (log, "event_id") if kind == "lsn" else (orders, "o_orderkey")
        page = read_from(table, token, key, "o_orderdate" if kind == "timestamp" else None, "lsn", 400)
        parts.append(page.select(F.lit(kind).alias("kind"), F.col(key).alias("key")))
    return union_all(parts)


@query(
    "i5_decode_checkpoints",
    f"""
    WITH e AS (SELECT *, event_id % 4 AS turn,
                 CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'start'
                   ELSE CASE WHEN event_type = 'view' AND event_id % 4 <> 1 THEN 'wrong_type' ELSE 'ok' END END AS status
               FROM events),
    k AS (SELECT *, status IN ('ok', 'wrong_type') AS known FROM e)
    SELECT event_id, status,
           CASE WHEN known THEN CASE turn WHEN 0 THEN 'offset' WHEN 1 THEN 'timestamp' WHEN 2 THEN 'lsn' ELSE 'subgraph' END END AS type,
           CASE WHEN status = 'start' THEN 0 WHEN known AND turn = 0 THEN event_id END AS "offset",
           CASE WHEN known AND turn = 0 THEN 1000::BIGINT END AS "limit",
           CASE WHEN known AND turn = 1 THEN ts END AS position_ts,
           CASE WHEN known AND turn = 1 THEN CAST(user_id AS VARCHAR) END AS last_id,
           CASE WHEN known AND turn = 2 THEN {LSN_SQL} END AS lsn,
           CASE WHEN known AND turn = 2 THEN 'shop' END AS database,
           CASE WHEN known AND turn = 3 THEN CAST(user_id % 5 AS INTEGER) END AS current_depth,
           CASE WHEN known THEN ts END AS created_at
    FROM k
    """,
)
def _(spark, sd):
    log = checkpoint_log(spark, sd)
    stored = F.when(F.col("event_type") == "error", "no token!").when(
        F.col("event_type") != "signup", F.col("token")
    )
    expected = F.when(F.col("event_type") == "view", "timestamp").otherwise(F.col("kind"))
    rows = log.select("event_id", stored.alias("token"), expected.alias("expected"))
    return decode_checkpoints(rows, "token", "expected").drop("token", "expected", "frontier", "completed_groups")


@query(
    "i6_stale_checkpoints",
    """
    WITH a AS (SELECT date_diff('microsecond', ts, TIMESTAMP '2024-01-20 00:00:00') / 1e6 AS age FROM events)
    SELECT age <= 86400 AS valid, count(*) AS checkpoints, max(age) AS oldest_seconds FROM a GROUP BY 1
    """,
)
def _(spark, sd):
    return stale_checkpoints(checkpoint_log(spark, sd), "token", "2024-01-20 00:00:00")


@query(
    "i7_latest_checkpoints",
    """
    SELECT event_type, user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM events GROUP BY event_type, user_id
    """,
)
def _(spark, sd):
    events = full_scan(spark, sd, "events").select("event_type", "user_id", "ts", "event_id")
    return latest_checkpoints(events, ["event_type", "user_id"], ["ts", "event_id"])
