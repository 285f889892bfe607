"""Checkpoint tokens: URL-safe base64 of `{type, position, timestamp}` as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Checkpoint types, and the fields of their positions.
POSITION_FIELDS = {
    "offset": "offset BIGINT, limit BIGINT",
    "timestamp": "timestamp STRING, last_id STRING",
    "lsn": "lsn STRING, database STRING, metadata MAP<STRING, STRING>",
    "subgraph": (
        "visited_nodes MAP<STRING, BOOLEAN>, current_depth INT, "
        "frontier ARRAY<STRUCT<entity_name: STRING, entity_key: STRING, depth: INT, group_id: STRING>>, "
        "completed_groups ARRAY<STRING>"
    ),
}
ALL_POSITION_FIELDS = ", ".join(POSITION_FIELDS.values())
TOKEN_SCHEMA = (
    f"type STRING, position STRUCT<{ALL_POSITION_FIELDS}>, "
    "metadata MAP<STRING, STRING>, timestamp STRING"
)
MAX_AGE_SECONDS = 24 * 60 * 60


def rfc3339(ts: Column) -> Column:
    """UTC text of a zone-less timestamp with microseconds; the session zone plays no part."""
    text = ts.cast("string")
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), fraction, F.lit("Z"))


def rfc3339_micros(text: Column) -> Column:
    """Microseconds since 1970 of text with any offset; NULL for anything that is no timestamp."""
    return F.unix_micros(text.try_cast("timestamp"))


def from_rfc3339(text: Column) -> Column:
    """The same as a zone-less UTC timestamp."""
    return F.timestamp_add("MICROSECOND", rfc3339_micros(text), F.lit("1970-01-01").cast("timestamp_ntz"))


def replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    """Several plain replacements; many times faster than `translate` on long text."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def url_base64(text: Column) -> Column:
    # `base64` breaks lines unless configured otherwise.
    return replaced(F.base64(F.encode(text, "UTF-8")), ("\r\n", ""), ("+", "-"), ("/", "_"))


def un_url_base64(token: Column) -> Column:
    """Decoded text; NULL when the token is no base64 or holds no text."""
    standard = replaced(token, ("-", "+"), ("_", "/"))
    return F.try_validate_utf8(F.try_to_binary(standard, F.lit("base64")).cast("string"))


def encode_token(kind: Column, position: Column, created: Column, metadata: Column | None = None) -> Column:
    """Token of a position struct; NULL fields are left out of the JSON. `metadata` is a map of texts."""
    more = [] if metadata is None else [metadata.alias("metadata")]
    body = F.struct(kind.alias("type"), position.alias("position"), *more, rfc3339(created).alias("timestamp"))
    return url_base64(F.to_json(body))


def parse_token(token: Column) -> Column:
    """`TOKEN_SCHEMA` struct of a token; its fields are NULL when the token is malformed."""
    return F.from_json(un_url_base64(token), TOKEN_SCHEMA)


def is_start(token: Column) -> Column:
    """No checkpoint yet: NULL or empty."""
    return token.isNull() | (token == "")


def lsn_sort_key(lsn: Column) -> Column:
    """Fixed-width form of a `hi/lo` hexadecimal log position; text order is number order.

    NULL for text of any other form.
    """
    hi = F.lpad(F.upper(F.substring_index(lsn, "/", 1)), 8, "0")
    lo = F.lpad(F.upper(F.substring_index(lsn, "/", -1)), 8, "0")
    return F.when(lsn.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), F.concat(hi, lo))


def lsn_number(lsn: Column) -> Column:
    """Log position as an exact unsigned 64-bit number."""
    return F.conv(lsn_sort_key(lsn), 16, 10).cast("decimal(20,0)")
