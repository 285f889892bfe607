import pytest
from pyspark.sql import functions as F

from headgate.operators.scan import read_hash, read_range, union_all
from headgate.plans.splits import (
    choose_strategy,
    range_splits,
    row_split_bounds,
    split_by_hash,
    split_by_range,
    split_by_rows,
    split_count,
)
from headgate.plans.statistics import NoKeyValues, collect_stats, cursor_column
from headgate.sources.jdbc import range_predicates

LONG_MAX = (1 << 63) - 1


def keyed(spark, keys):
    return spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "k BIGINT, v DOUBLE")


KEY_SETS = {
    "dense": list(range(100)),
    "sparse": [i * i * 37 for i in range(60)],
    "negative": list(range(-40, 25, 3)),
    "hot": [7] * 50 + [1, 2, 900],
    "one_row": [5],
    "one_value": [5] * 10,
    "extremes": [-LONG_MAX - 1, -3, 0, 4, LONG_MAX],
    "top": [LONG_MAX - 9, LONG_MAX - 3, LONG_MAX],
}


@pytest.mark.parametrize("keys", KEY_SETS.values(), ids=KEY_SETS.keys())
@pytest.mark.parametrize("n", [1, 4, 32])
def test_range_splits_are_disjoint_and_complete(spark, keys, n):
    df = keyed(spark, keys)
    splits = range_splits(df, "k", n)
    tagged = df.withColumn("i", splits.index()).collect()
    bounds = splits.bounds()
    assert len(bounds) == splits.n
    for row in tagged:
        lo, hi = bounds[row.i]
        assert lo <= row.k < hi
        assert sum(lo <= row.k < hi for lo, hi in bounds) == 1


def test_range_width_rule(spark):
    splits = range_splits(keyed(spark, range(10, 113)), "k", 4)
    assert splits.bounds() == [(10, 35), (35, 60), (60, 85), (85, 113)]
    plan = splits.plan(spark).orderBy("split_index").collect()
    assert [(r.lo, r.hi) for r in plan] == splits.bounds()
    assert {r.estimated_rows for r in plan} == {103 // 4}
    assert plan[3].metadata == {
        "strategy": "primary_key", "column": "k", "min_value": "85", "max_value": "113", "split_index": "3",
    }


def test_more_splits_than_key_values(spark):
    df = keyed(spark, [1, 2, 3])
    report = range_splits(df, "k", 8).report(df, "v").orderBy("split_id").collect()
    assert [r.row_count for r in report] == [1, 1, 1, 0, 0, 0, 0, 0]
    assert report[0].split_id == "split-0000" and report[7].split_id == "split-0007"


def test_open_end_when_the_largest_key_is_the_largest_bigint(spark):
    splits = range_splits(keyed(spark, KEY_SETS["top"]), "k", 2)
    assert [r.hi for r in splits.plan(spark).orderBy("lo").collect()][-1] is None


def test_empty_table_is_one_split(spark):
    df = keyed(spark, [])
    splits = range_splits(df, "k", 4)
    assert splits.n == 1
    assert splits.report(df, "v").first().row_count == 0
    assert split_by_rows(df, "k", 4).count() == 0


def test_all_null_key_is_an_error(spark):
    df = spark.createDataFrame([(None,), (None,)], "k BIGINT")
    with pytest.raises(NoKeyValues):
        collect_stats(df, "k")


@pytest.mark.parametrize(
    ("rows", "desired", "target", "expected"),
    [
        (0, 4, 1000, 1),
        (1000, 4, 1000, 1),
        (1001, 4, 1000, 4),
        (1001, 0, 1000, 2),
        (10**9, 0, 1_000_000, 32),
        (10**9, 100, 1_000_000, 32),
    ],
)
def test_split_count(rows, desired, target, expected):
    assert split_count(rows, desired, target) == expected


def test_more_splits_than_the_default_if_wished():
    assert split_count(10**12, 5_000) == 32 and split_count(10**12, 5_000, most=10_000) == 5_000


def test_strategy_follows_the_key_type(spark):
    schema = spark.createDataFrame([], "a INT, b STRING, c BIGINT, d SMALLINT").schema
    assert [choose_strategy(schema[c].dataType) for c in "abcd"] == [
        "primary_key", "row_number", "primary_key", "primary_key",
    ]
    assert choose_strategy(None) == "row_number"


def test_text_keys_split_by_rows(spark):
    df = spark.createDataFrame([(f"key-{i:03d}",) for i in range(50)], "k STRING")
    counts = dict(split_by_range(df, "k", 4).groupBy("split_id").count().collect())
    assert counts == {"split-0000": 12, "split-0001": 12, "split-0002": 12, "split-0003": 14}


@pytest.mark.parametrize(("rows", "n"), [(50, 4), (3, 4), (4, 4), (1, 1), (97, 7)])
def test_row_splits_have_equal_counts_and_the_remainder_last(spark, rows, n):
    df = keyed(spark, [i * 11 % 1009 for i in range(rows)])
    tagged = split_by_rows(df, "k", n).collect()
    in_order = sorted(tagged, key=lambda r: r.k)
    expected = [f"split-{i:04d}" for i, (_, size) in enumerate(row_split_bounds(rows, n)) for _ in range(size)]
    assert [r.split_id for r in in_order] == expected


def test_hash_splits_are_disjoint_and_complete(spark):
    df = keyed(spark, range(-300, 300))
    parts = union_all([read_hash(df, "k", 7, i) for i in range(7)])
    assert sorted(r.k for r in parts.collect()) == list(range(-300, 300))
    assert split_by_hash(df, "k", 7).select("split_id").distinct().count() == 7


def test_open_ranges(spark):
    df = keyed(spark, range(10))
    assert read_range(df, "k", None, 3).count() == 3
    assert read_range(df, "k", 7, None, ["v"]).columns == ["v"]
    assert read_range(df, "k", None, None).count() == 10


def test_jdbc_predicates_cover_every_key_once(spark):
    df = keyed(spark, KEY_SETS["sparse"])
    predicates = [p.replace('"', "`") for p in range_predicates(range_splits(df, "k", 5))]
    hits = df.select(sum(F.expr(p).cast("int") for p in predicates).alias("n"))
    assert {r.n for r in hits.collect()} == {1}


def test_cursor_column_rule(spark):
    first = spark.createDataFrame([], "created_at STRING, b TIMESTAMP_NTZ, a TIMESTAMP")
    assert cursor_column(first) == "b"
    assert cursor_column(spark.createDataFrame([], "id INT, created_at STRING")) == "created_at"
    with pytest.raises(ValueError, match="no column"):
        cursor_column(spark.createDataFrame([], "id INT"))


@pytest.mark.parametrize("n", [1, 3, 8])
def test_rows_without_a_key_are_in_one_split(spark, n):
    df = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), "id")
    plan = range_splits(df, "k", n)
    parts = [read_range(df, "k", lo, hi, nulls=i == 0) for i, (lo, hi) in enumerate(plan.bounds())]
    sizes = [p.count() for p in parts]
    tagged = {r["split_id"]: r["count"] for r in split_by_range(df, "k", n).groupBy("split_id").count().collect()}
    assert sum(sizes) == 100 and [tagged[f"split-{i:04d}"] for i in range(n)] == sizes
    assert union_all([read_hash(df, "k", n, i) for i in range(n)]).count() == 100
    assert split_by_hash(df, "k", n).where("split_id IS NULL").count() == 0
