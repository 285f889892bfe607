"""Reads that go on from tokens, statistics from footers, measures taken while writing."""

import pytest
from pyspark.sql import functions as F

from headgate.functions.tokens import encode_token, rfc3339
from headgate.operators.envelope import observed_extract
from headgate.operators.graph import resume_token, traversal_token, traverse
from headgate.operators.incremental import read_from
from headgate.plans.statistics import FROM_FOOTERS, footer_stats, table_stats
from headgate.session import settings, workspace


def token_of(spark, kind, position, metadata=None):
    created = F.lit("2024-02-01").cast("timestamp_ntz")
    return spark.range(1).select(encode_token(F.lit(kind), position, created, metadata)).first()[0]


def events(spark, n=23):
    at = F.timestamp_add("SECOND", (F.col("id") % 4).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    lsn = F.concat(F.lit("1/"), F.hex(F.col("id") + 10))
    return spark.range(n).select("id", F.when(F.col("id") % 5 > 0, at).alias("at.ts"), lsn.alias("lsn"))


def test_each_kind_of_token_reads_on_to_the_end(spark):
    df = events(spark)
    want = [r.id for r in df.orderBy(F.col("`at.ts`").asc_nulls_last(), "id").collect()]
    seen, token = [], None
    while page := read_from(df, token, "id", "at.ts", limit=7).collect():
        seen += [r.id for r in page]
        last = page[-1]
        at = F.lit(str(last[1])).cast("timestamp_ntz") if last[1] else F.lit(None).cast("timestamp_ntz")
        token = token_of(spark, "timestamp", F.struct(rfc3339(at).alias("timestamp"), F.lit(str(last.id)).alias("last_id")))
        assert len(seen) <= 23
    assert seen == want
    seen = []
    while page := read_from(df, token_of(spark, "offset", F.struct(F.lit(len(seen)).alias("offset"))), "id", limit=9).collect():
        seen += [r.id for r in page]
    assert seen == list(range(23))
    lsn = token_of(spark, "lsn", F.struct(F.lit("1/1A").alias("lsn")))
    assert [r.id for r in read_from(df, lsn, "id", lsn="lsn").collect()] == list(range(17, 23))
    assert [r.id for r in read_from(df, "", "id", limit=3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("token", ["no token!", "e30="])
def test_a_token_without_a_position_is_an_error(spark, token):
    with pytest.raises(ValueError, match="no position"):
        read_from(events(spark), token, "id", "at.ts", "lsn")
    with pytest.raises(ValueError, match="state folder"):
        resume_token(spark, token)


def test_a_traversal_goes_on_from_its_token(spark):
    edges = spark.createDataFrame([("n", str(i), "n", str(i + 1)) for i in range(6)], "src_entity STRING, src_key STRING, dst_entity STRING, dst_key STRING")
    roots = spark.createDataFrame([("n", "0", "g")], "entity STRING, key STRING, group_id STRING")
    state = workspace(spark, "t")
    traverse(edges, roots, 2, state, by_group=True)
    token = traversal_token(spark, state, 2, "2024-02-01", by_group=True, tenant="a \"b\"")
    got = {(r.key, r.group_id): r.depth for r in resume_token(spark, token, 5).collect()}
    assert got == {(str(i), "g"): i for i in range(6)}


def test_statistics_come_from_footers(spark, sd):
    path = f"{sd}/lineitem.parquet"
    with settings(spark, FROM_FOOTERS):
        plan = table_stats(spark.read.parquet(path), "l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plan
    assert footer_stats(spark, path, "l_orderkey").first() == table_stats(spark.read.parquet(path), "l_orderkey").first()
    # Text has no exact bounds in footers: the column is read.
    assert footer_stats(spark, path, "l_returnflag").first() == table_stats(spark.read.parquet(path), "l_returnflag").first()
    base = workspace(spark, "t")
    spark.createDataFrame([], "k BIGINT").write.parquet(base)
    assert tuple(footer_stats(spark, base, "k").first()) == (0, None, None)
    assert all(spark.conf.get(k) != v for k, v in FROM_FOOTERS.items())


def test_a_write_measures_itself(spark):
    rows = events(spark, 1000).withColumn("text", F.when(F.col("id") % 2 == 0, "é"))
    base = workspace(spark, "t")
    got = observed_extract(rows.repartition(7), base, F.octet_length("text"), "at.ts").first()
    assert (got.records, got.bytes, str(got.watermark)) == (1000, 1000, "2024-01-01 00:00:03")
    assert spark.read.parquet(base).count() == 1000
    empty = observed_extract(rows.limit(0), f"{base}-empty", F.octet_length("text"), "at.ts").first()
    assert tuple(empty) == (0, 0, None)
