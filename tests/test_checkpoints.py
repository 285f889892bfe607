import base64
import json

import pytest
from pyspark.sql import functions as F

from headgate.functions.tokens import encode_token, lsn_number, lsn_sort_key, parse_token, url_base64
from headgate.operators.incremental import (
    after_lsn,
    checkpoint_age,
    decode_checkpoints,
    incremental,
    latest_checkpoints,
)


def token(body: object) -> str:
    return base64.urlsafe_b64encode(body if isinstance(body, bytes) else json.dumps(body).encode()).decode()


FRONTIER = [{"entity_name": "orders", "entity_key": "5", "depth": 2, "group_id": "g"}]
CASES = [
    ("offset", token({"type": "offset", "position": {"offset": 7, "limit": 3}, "timestamp": "2024-01-01T00:00:00Z"}), "ok"),
    ("offset", None, "start"),
    ("offset", "", "start"),
    ("offset", "%%%", "malformed"),
    ("offset", "abc", "malformed"),
    ("offset", token(b"\xff\xfe\xfd"), "malformed"),
    ("offset", token("just text"), "malformed"),
    ("offset", token({"type": "odd", "position": {}, "timestamp": "2024-01-01T00:00:00Z"}), "malformed"),
    ("lsn", token({"type": "offset", "position": {"offset": 7}, "timestamp": "2024-01-01T00:00:00Z"}), "wrong_type"),
    ("lsn", token({"type": "lsn", "position": {"lsn": "1/2B", "database": "d"}, "timestamp": "2024-01-01T02:00:00+02:00"}), "ok"),
    ("timestamp", token({"type": "timestamp", "position": {"timestamp": "2024-01-01T00:00:00.123456789Z", "last_id": "é"}, "timestamp": "2024-01-01T00:00:00Z"}), "ok"),
    ("subgraph", token({"type": "subgraph", "position": {"visited_nodes": {"orders:5": True}, "current_depth": 2, "frontier": FRONTIER, "completed_groups": ["a"]}, "timestamp": "2024-01-01T00:00:00Z"}), "ok"),
]


@pytest.fixture(scope="module")
def decoded(spark):
    df = spark.createDataFrame([(i, e, t) for i, (e, t, _) in enumerate(CASES)], "i INT, expected STRING, token STRING")
    return {r.i: r for r in decode_checkpoints(df, "token", "expected").collect()}


def test_status_of_every_token(decoded):
    assert [decoded[i].status for i in range(len(CASES))] == [s for _, _, s in CASES]


def test_positions(decoded):
    assert (decoded[0].offset, decoded[0].limit) == (7, 3)
    assert decoded[1].offset == 0 and decoded[2].offset == 0
    assert (decoded[9].lsn, decoded[9].database, str(decoded[9].created_at)) == ("1/2B", "d", "2024-01-01 00:00:00")
    assert (str(decoded[10].position_ts), decoded[10].last_id) == ("2024-01-01 00:00:00.123456", "é")
    assert decoded[11].current_depth == 2 and decoded[11].completed_groups == ["a"]
    assert decoded[11].frontier[0].entity_name == "orders"


def test_encoded_token_is_what_a_plain_decoder_reads(spark):
    position = F.struct(F.lit("x" * 200).alias("last_id"))
    at = F.lit("1960-02-03 04:05:06.7").cast("timestamp_ntz")
    t = spark.range(1).select(encode_token(F.lit("timestamp"), position, at).alias("t")).first().t
    assert json.loads(base64.urlsafe_b64decode(t)) == {
        "type": "timestamp", "position": {"last_id": "x" * 200}, "timestamp": "1960-02-03T04:05:06.700000Z",
    }


def test_url_safe_alphabet(spark):
    df = spark.range(1).select(url_base64(F.lit("??>>ÿÿ~~")).alias("t"))
    assert base64.urlsafe_b64decode(df.first().t).decode() == "??>>ÿÿ~~"
    parsed = spark.range(1).select(parse_token(F.lit(token({"type": "offset", "position": {"offset": 1}}))).alias("p"))
    assert parsed.first().p.position.offset == 1


def test_age_and_validity(spark):
    def at(stamp):
        return token({"type": "offset", "position": {"offset": 1}, "timestamp": stamp})

    rows = [(0, None), (1, ""), (2, at("2024-01-02T00:00:00Z")), (3, at("2024-01-01T00:00:00Z")), (4, at("2023-12-31T23:59:59.999Z")),
            (5, "junk!"), (6, at("not a time"))]
    df = spark.createDataFrame(rows, "i INT, token STRING")
    got = {r.i: (r.valid, r.age_seconds) for r in checkpoint_age(df, "token", "2024-01-02 00:00:00").collect()}
    assert got == {
        0: (True, 0.0), 1: (True, 0.0), 2: (True, 0.0), 3: (True, 86400.0), 4: (False, 86400.001), 5: (False, None), 6: (False, None),
    }


def test_log_positions_compare_as_numbers(spark):
    df = spark.createDataFrame([(p,) for p in ["0/9", "0/10", "A/0", "9/FFFFFFFF", "FFFFFFFF/FFFFFFFF", "0/a"]], "lsn STRING")
    assert {r.lsn for r in after_lsn(df, "lsn", "0/A").collect()} == {"0/10", "A/0", "9/FFFFFFFF", "FFFFFFFF/FFFFFFFF"}
    ordered = df.orderBy(lsn_sort_key(F.col("lsn"))).select("lsn", lsn_number(F.col("lsn")).alias("n")).collect()
    assert [r.lsn for r in ordered][-2:] == ["A/0", "FFFFFFFF/FFFFFFFF"]
    assert int(ordered[-1].n) == 2**64 - 1


def test_incremental_without_a_cursor_reads_from_the_start(spark):
    df = spark.createDataFrame([(i, f"2024-01-0{i}") for i in (3, 1, 2)], "id INT, day STRING")
    df = df.withColumn("updated", F.col("day").cast("timestamp_ntz"))
    assert [r.id for r in incremental(df, None, None, 2).collect()] == [1, 2]
    assert [r.id for r in incremental(df, None, "2024-01-01").collect()] == [2, 3]


def test_latest_checkpoint_per_group(spark):
    df = spark.createDataFrame([("e", "g", 1, "a"), ("e", "g", 3, "b"), ("e", "h", 2, "c")], "entity STRING, grp STRING, w INT, token STRING")
    got = {(r.entity, r.grp): r.token for r in latest_checkpoints(df, ["entity", "grp"], ["w"]).collect()}
    assert got == {("e", "g"): "b", ("e", "h"): "c"}


def test_pages_go_on_through_rows_without_a_timestamp(spark):
    from headgate.operators.incremental import resume

    rows = [(i, None if i < 5 else f"2024-01-0{1 + i % 3} 00:00:00") for i in range(12)]
    df = spark.createDataFrame(rows, "`row.id` long, `at.ts` string").selectExpr("`row.id`", "CAST(`at.ts` AS timestamp_ntz) AS `at.ts`")
    seen, t, last = [], None, None
    while page := resume(df, "at.ts", "row.id", t, last, 3).collect():
        seen += [r[0] for r in page]
        t, last = page[-1][1] and str(page[-1][1]), page[-1][0]
        assert len(seen) <= 12
    assert seen == [6, 9, 7, 10, 5, 8, 11, 0, 1, 2, 3, 4]
