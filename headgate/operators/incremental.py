"""Incremental reads, resumption and checkpoint logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.functions.names import column
from headgate.functions.tokens import (
    MAX_AGE_SECONDS,
    POSITION_FIELDS,
    from_rfc3339,
    is_start,
    lsn_sort_key,
    parse_token,
    rfc3339_micros,
)
from headgate.functions.values import ntz_literal, ntz_micros
from headgate.operators.scan import after_cursor
from headgate.plans.rows import plan_rows
from headgate.plans.statistics import cursor_column


def incremental(df: DataFrame, ts: str | None, cursor: str | None, limit: int | None = None) -> DataFrame:
    """Rows strictly after the cursor in timestamp order: all of them, or at most `limit`.

    With a limit, rows that tie with the last one may be left behind; `resume` does not have that gap.
    """
    ts = ts or cursor_column(df)
    rows = df.where(after_cursor(ts, cursor)).orderBy(ts)
    return rows if limit is None else rows.limit(limit)


def after_position(ts: str, key: str, t: str | None, last: object) -> Column:
    """Rows after `(t, last)` in the order of timestamp, missing ones at the end, then key.

    The plain bound on `ts` is stated too, so that the scan can prune. Without `t` the position is
    among the rows that have no timestamp.
    """
    c, k = column(ts), column(key)
    if t is None:
        return c.isNull() & (k > F.lit(last))
    at = F.lit(t)
    return ((c >= at) & ((c > at) | ((c == at) & (k > F.lit(last))))) | c.isNull()


def resume(df: DataFrame, ts: str, key: str, t: str | None, last: object, limit: int) -> DataFrame:
    """The next page after the row at `(t, last)`; without both, the first page.

    Ties at the page edge are neither lost nor repeated. Rows without a timestamp come last, by key;
    a page that ends among them gives the position `(None, last)`. `key` is unique and not null.
    """
    rows = df if t is None and last is None else df.where(after_position(ts, key, t, last))
    return rows.orderBy(column(ts).asc_nulls_last(), column(key)).limit(limit)


def after_lsn(df: DataFrame, lsn: str, position: str) -> DataFrame:
    """Change rows after a log position, compared as numbers, not as text."""
    return df.where(lsn_sort_key(F.col(lsn)) > lsn_sort_key(F.lit(position)))


def read_from(df: DataFrame, token: str | None, key: str, ts: str | None = None, lsn: str | None = None, limit: int = 1000) -> DataFrame:
    """The next page of `df` after the position that a token of any kind names, in the order of that kind.

    An offset counts rows in the order of `key`, and its own limit goes before `limit`; a timestamp
    goes on after its `(ts, key)`; a log position after its `lsn`. Without a token the page is the
    first one by `ts` and key, or by key alone. A token that says nothing is an error.
    """
    asked = df.sparkSession.range(1).select(parse_token(F.lit(token).cast("string")).alias("p"))
    at = from_rfc3339(F.col("p.position.timestamp")).cast("string").alias("at")
    found = asked.select("p.type", at, "p.position.offset", "p.position.limit", "p.position.last_id", "p.position.lsn").first()
    if not token:
        return df.orderBy(*([column(ts).asc_nulls_last()] if ts else []), column(key)).limit(limit)
    if found.type == "offset" and found.offset is not None:
        wanted = found.limit or limit
        return plan_rows(df, key).slice(df, found.offset, wanted).orderBy(column(key))
    if found.type == "timestamp" and ts and (found.at or found.last_id) is not None:
        last = F.lit(found.last_id).cast(df.schema[key].dataType)
        return resume(df, ts, key, found.at, last, limit)
    if found.type == "lsn" and lsn and found.lsn is not None:
        return after_lsn(df, lsn, found.lsn).orderBy(lsn_sort_key(column(lsn)), column(key)).limit(limit)
    raise ValueError(f"a token of type {found.type} has no position that this read can go on from")


def decode_checkpoints(df: DataFrame, token: str, expected: str) -> DataFrame:
    """Typed position of every token.

    `status` is `start` for a missing token, `malformed`, `wrong_type` when the token's type is
    not the one in column `expected`, else `ok`.
    """
    parsed = F.col("_parsed")
    known = parsed["type"].isin(list(POSITION_FIELDS))
    status = (
        F.when(is_start(F.col(token)), "start")
        .when(parsed["type"].isNull() | ~known, "malformed")
        .when(parsed["type"] != F.col(expected), "wrong_type")
        .otherwise("ok")
    )
    return df.withColumn("_parsed", parse_token(F.col(token))).select(
        *df.columns,
        status.alias("status"),
        parsed["type"].alias("type"),
        F.coalesce(parsed["position"]["offset"], F.when(is_start(F.col(token)), F.lit(0))).alias("offset"),
        parsed["position"]["limit"].alias("limit"),
        from_rfc3339(parsed["position"]["timestamp"]).alias("position_ts"),
        parsed["position"]["last_id"].alias("last_id"),
        parsed["position"]["lsn"].alias("lsn"),
        parsed["position"]["database"].alias("database"),
        parsed["position"]["current_depth"].alias("current_depth"),
        parsed["position"]["frontier"].alias("frontier"),
        parsed["position"]["completed_groups"].alias("completed_groups"),
        from_rfc3339(parsed["timestamp"]).alias("created_at"),
    )


def checkpoint_age(df: DataFrame, token: str, as_of: str) -> DataFrame:
    """Age and validity of every checkpoint at `as_of`.

    Missing tokens are valid start positions of age 0; a token must decode and be at most a day old.
    """
    created = rfc3339_micros(parse_token(F.col(token))["timestamp"])
    age = (ntz_micros(ntz_literal(as_of)) - created) / F.lit(1e6)
    return df.withColumn("age_seconds", F.when(is_start(F.col(token)), F.lit(0.0)).otherwise(age)).withColumn(
        "valid", F.coalesce(F.col("age_seconds") <= MAX_AGE_SECONDS, F.lit(False))
    )


def stale_checkpoints(df: DataFrame, token: str, as_of: str) -> DataFrame:
    """Counts and oldest age of valid and invalid checkpoints."""
    return (
        checkpoint_age(df, token, as_of)
        .groupBy("valid")
        .agg(F.count(F.lit(1)).alias("checkpoints"), F.max("age_seconds").alias("oldest_seconds"))
    )


def latest_checkpoints(df: DataFrame, group: list[str], watermark: list[str]) -> DataFrame:
    """The newest checkpoint row of every group."""
    rest = [c for c in df.columns if c not in group]
    newest = df.groupBy(*group).agg(F.max_by(F.struct(*rest), F.struct(*watermark)).alias("_row"))
    return newest.select(*group, "_row.*")
