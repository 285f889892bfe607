import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from headgate import catalogue
from headgate.catalogue import streams
from headgate.operators.envelope import extract
from headgate.session import settings, workspace
from headgate.streaming import upserts
from headgate.streaming.delivery import STATE_SETTINGS, deliver_once
from headgate.streaming.extract import (
    extract_stream,
    for_all_records,
    for_each_batch,
    for_each_records,
    map_batches,
    state_writer,
    stream_table,
)
from headgate.streaming.upserts import manifests, read_upserts, runs_of, upsert_writer


def numbered(spark, lo, hi):
    at = F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))
    return spark.range(lo, hi, 1, 1).select("id", (F.col("id") % 5).alias("k"), at.alias("ts"))


def test_a_restarted_extraction_goes_on_where_it_stopped(spark):
    base = workspace(spark, "t")
    for lo, hi in [(0, 50), (50, 80), (80, 80)]:
        numbered(spark, lo, hi).write.mode("append").parquet(f"{base}/in")
        extract_stream(stream_table(spark, f"{base}/in"), f"{base}/out", f"{base}/position").awaitTermination()
    ids = [r.id for r in spark.read.parquet(f"{base}/out").orderBy("id").collect()]
    assert ids == list(range(80))


def test_batches_are_bounded(spark):
    base = workspace(spark, "t")
    numbered(spark, 0, 90).repartition(3, "id").write.parquet(f"{base}/in")
    stream = stream_table(spark, f"{base}/in", files_per_batch=1)
    for_each_batch(stream, state_writer(f"{base}/out", "ts"), f"{base}/position").awaitTermination()
    states = spark.read.parquet(f"{base}/out").collect()
    assert len(states) == 3 and sum(r.records for r in states) == 90
    assert str(max(r.watermark for r in states)) == "2024-01-01 00:01:29"


def test_batches_hold_a_bounded_number_of_records(spark):
    base, seen = workspace(spark, "t"), []
    numbered(spark, 0, 95).withColumn("_part", F.lit("own")).repartition(4).write.parquet(f"{base}/in")

    def take(rows, batch_id, part):
        assert rows.columns == ["id", "k", "ts", "_part"]
        seen.append((batch_id, part, [r.id for r in rows.collect()]))

    for_each_records(stream_table(spark, f"{base}/in", files_per_batch=3), take, 10, f"{base}/position").awaitTermination()
    assert sorted(i for _, _, ids in seen for i in ids) == list(range(95))
    for batch_id in {b for b, _, _ in seen}:
        sizes = [len(ids) for b, _, ids in seen if b == batch_id]
        assert sizes[:-1] == [10] * (len(sizes) - 1) and 0 < sizes[-1] <= 10
    with pytest.raises(ValueError, match="at least one"):
        for_each_records(stream_table(spark, f"{base}/in"), take, 0, f"{base}/other")


def test_states_of_many_bounded_batches_are_written_at_once(spark, sd, monkeypatch):
    calls, real = [], streams.state_writer

    def counted(path, ts):
        write = real(path, ts)
        return lambda *args: (calls.append(args[1]), write(*args))

    monkeypatch.setattr(streams, "RECORDS", 7)
    monkeypatch.setattr(streams, "state_writer", counted)
    rows = spark.read.parquet(f"{sd}/events.parquet").count()
    assert tuple(catalogue.QUERIES["t2_bounded_records"](spark, sd).first()) == (-(-rows // 7), 7, rows)
    assert len(calls) == 1  # not one for each of the parts


def test_parts_of_a_batch_as_a_column(spark):
    base, seen = workspace(spark, "t"), []
    numbered(spark, 0, 95).withColumn("_part", F.lit("own")).repartition(4).write.parquet(f"{base}/in")

    def take(rows, batch_id, part):
        assert rows.columns == ["id", "k", "ts", "_part", part]
        seen.append([(r[part], r.id) for r in rows.collect()])
        assert sorted(seen[-1]) == sorted((r[part], r.id) for r in rows.collect())

    for_all_records(stream_table(spark, f"{base}/in", files_per_batch=3), take, 10, f"{base}/position").awaitTermination()
    assert sorted(i for rows in seen for _, i in rows) == list(range(95)) and len(seen) == 2
    for rows in seen:
        sizes = [sum(p == n for p, _ in rows) for n in range(-(-len(rows) // 10))]
        assert sum(sizes) == len(rows) and sizes[:-1] == [10] * (len(sizes) - 1)
    with pytest.raises(ValueError, match="at least one"):
        for_all_records(stream_table(spark, f"{base}/in"), take, 0, f"{base}/other")


def test_callbacks_over_a_number_of_records(spark):
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        rows = spark.range(0, 103, 1, 2).select("id")
        sizes = [r.n for r in map_batches(rows, lambda b: pd.DataFrame({"n": [len(b)], "s": [b["id"].sum()]}), "n BIGINT, s BIGINT", records=10).collect()]
    assert sorted(sizes) == sorted([10] * 5 + [1] + [10] * 5 + [2])


def test_a_repeated_batch_changes_nothing(spark):
    base = workspace(spark, "t")
    write = upsert_writer(base, "k", ["ts", "id"])
    write(numbered(spark, 0, 20), 0)
    write(numbered(spark, 20, 33), 1)
    before = sorted(read_upserts(spark, base, "k", ["ts", "id"]).collect())
    write(numbered(spark, 20, 33), 1)
    write(numbered(spark, 0, 20), 2)
    assert sorted(read_upserts(spark, base, "k", ["ts", "id"]).collect()) == before
    assert sorted((r.k, r.id) for r in before) == [(0, 30), (1, 31), (2, 32), (3, 28), (4, 29)]


def test_many_batches_are_few_runs(spark):
    base, order = workspace(spark, "t"), ["ts", "id"]
    write = upsert_writer(base, "k", order, buckets=2)
    rows = numbered(spark, 0, 130).selectExpr("id", "CASE WHEN k < 4 THEN k END AS k", "ts", "id % 3 AS batch", "'x' AS _row")
    for batch in range(13):
        write(rows.where(f"(id * 7) % 13 = {batch}"), batch)
        runs, _ = runs_of(spark, base, manifests(spark, base)[-1])
        assert len(runs) == (batch + 1).bit_count() and [r.first for r in runs[1:]] == [r.last + 1 for r in runs[:-1]]
    got = read_upserts(spark, base, "k", order)
    assert got.columns == ["id", "k", "ts", "batch", "_row"]
    assert {(r.k, r.id, r.batch) for r in got.collect()} == {(k, i, i % 3) for k, i in [(0, 125), (1, 126), (2, 127), (3, 128), (None, 129)]}
    # One file of each run for a bucket; what no recent manifest names is gone.
    folders = upserts.Files(spark, base).names(f"{base}/runs")
    assert {r.folder(base).split("/")[-1] for r in runs} <= set(folders) and len(folders) <= 7
    for run in runs:
        files = upserts.read_runs(spark, base, [run], got.schema).inputFiles()
        assert len(files) == len({f.split("/")[-2] for f in files}) <= 2


@pytest.mark.parametrize("broken", ["write_manifest", "newest_per_key", "forget"])
def test_a_crash_within_a_batch_changes_nothing(spark, monkeypatch, broken):
    base, order = workspace(spark, "t"), ["ts", "id"]
    write = upsert_writer(base, "k", order)
    parts = [numbered(spark, 10 * i, 10 * i + 10) for i in range(4)]
    for i in range(3):
        write(parts[i], i)
    before, real, calls = sorted(read_upserts(spark, base, "k", order).collect()), getattr(upserts, broken), []

    def crash(*args):
        calls.append(args)
        # The first merge of the rows is the batch's own, the second is that with the run before.
        if broken != "newest_per_key" or len(calls) == 2:
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(upserts, broken, crash)
    with pytest.raises(OSError, match="lost"):
        write(parts[3], 3)
    monkeypatch.setattr(upserts, broken, real)
    if broken != "forget":  # the table was swapped before that
        assert sorted(read_upserts(spark, base, "k", order).collect()) == before
    write(parts[3], 3)
    assert sorted(r.id for r in read_upserts(spark, base, "k", order).collect()) == [35, 36, 37, 38, 39]


def test_upserts_of_nothing_and_reserved_names(spark):
    base = workspace(spark, "t")
    with pytest.raises(ValueError, match="no batch"):
        read_upserts(spark, base, "k", ["ts"])
    write = upsert_writer(base, "k", ["ts"])
    write(numbered(spark, 0, 0), 0)
    assert read_upserts(spark, base, "k", ["ts"]).count() == 0
    write(numbered(spark, 0, 0), 1)
    write(numbered(spark, 0, 3), 2)
    assert read_upserts(spark, base, "k", ["ts"]).count() == 3
    with pytest.raises(ValueError, match="__bucket"):
        write(numbered(spark, 0, 1).withColumn("__bucket", F.lit(1)), 3)


def test_redelivered_rows_collapse_and_late_ones_stay(spark):
    base = workspace(spark, "t")
    for lo, hi in [(40, 60), (0, 20), (40, 60), (10, 50)]:
        numbered(spark, lo, hi).write.mode("append").parquet(f"{base}/in")
        stream = stream_table(spark, f"{base}/in", files_per_batch=1)
        deliver_once(stream, "id", f"{base}/out", f"{base}/position").awaitTermination()
    ids = [r.id for r in spark.read.parquet(f"{base}/out").orderBy("id").collect()]
    assert ids == list(range(60))
    assert all(spark.conf.get(name, None) != value for name, value in STATE_SETTINGS.items())


def test_state_holds_each_key_once_over_many_batches(spark):
    base = workspace(spark, "t")
    rows = numbered(spark, 0, 60).selectExpr("CASE WHEN id >= 5 THEN id END AS `a.key`", "id % 2 AS batch", "ts")
    rows.unionByName(rows).repartition(12).write.parquet(f"{base}/in")
    query = deliver_once(stream_table(spark, f"{base}/in", files_per_batch=1), "a.key", f"{base}/out", f"{base}/position")
    query.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert out.columns == rows.columns
    got = sorted(((r[0] is None, r[0] or 0), r.batch) for r in out.collect())
    # Rows without a key cannot be told to be the same: both deliveries of them stay.
    assert got == sorted([((False, i), i % 2) for i in range(5, 60)] + [((True, 0), i % 2) for i in range(5)] * 2)
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert len(progress) == 12 and query.lastProgress.stateOperators[0].numRowsTotal == 55
    written = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators]
    assert sum(written) == 55  # a batch adds its own new keys, not those of earlier batches


def test_state_partitions_do_not_grow_with_shuffles(spark):
    base = workspace(spark, "t")
    numbered(spark, 0, 60).write.parquet(f"{base}/in")
    used = []
    with settings(spark, {"spark.sql.shuffle.partitions": "60"}):
        for name, more in [("a", {}), ("b", {"partitions": 3})]:
            query = deliver_once(stream_table(spark, f"{base}/in"), "id", f"{base}/{name}", f"{base}/at-{name}", **more)
            query.awaitTermination()
            used.append(query.lastProgress.stateOperators[0].numShufflePartitions)
            assert sorted(r.id for r in spark.read.parquet(f"{base}/{name}").collect()) == list(range(60))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "60"
    assert used == [12, 3]


def test_an_error_in_a_callback_stops_the_read(spark):
    base = workspace(spark, "t")
    numbered(spark, 0, 10).write.parquet(f"{base}/in")

    def fail(batch, batch_id):
        raise ValueError("no more")

    with pytest.raises(StreamingQueryException, match="no more"):
        for_each_batch(stream_table(spark, f"{base}/in"), fail, f"{base}/position").awaitTermination()


def test_callback_over_batches(spark):
    got = map_batches(numbered(spark, 0, 10).select("id"), lambda b: b.assign(twice=b["id"] * 2), "id BIGINT, twice BIGINT")
    assert got.agg(F.sum("twice")).first()[0] == 90


def test_extracted_state_matches_what_was_written(spark):
    base = workspace(spark, "t")
    tied = numbered(spark, 0, 10).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    rows, state = extract(tied, base, "e", "id", "2024-02-01", "ts", "g")
    row = state.first()
    assert rows.count() == row.records == 10
    assert (row.entity, row.group_id, row.last_key, row.watermark) == ("e", "g", 9, 1704067200000000)
