import pytest
from pyspark.sql import functions as F

from headgate.plans.splits import split_by_rows
from headgate.operators.incremental import resume
from headgate.plans.rows import bucket_count, numbered, page, paginate, plan_rows


def shuffled(spark, n, step=7919):
    """Keys with many ties in `t`, unique together with `id`."""
    ids = spark.range(n).select(((F.col("id") * step) % n).alias("id"))
    day = F.timestamp_add("DAY", (F.col("id") % 13).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    return ids.select("id", day.alias("t"))


@pytest.mark.parametrize("buckets", [1, 2, 9, 47, 60, 200])
@pytest.mark.parametrize("keys", [["id"], ["t", "id"]])
def test_row_index_is_the_position_in_key_order(spark, buckets, keys):
    df = shuffled(spark, 3000)
    plan = plan_rows(df, keys, buckets)
    rows = sorted(plan.index(df).collect(), key=lambda r: tuple(r[k] for k in keys))
    assert [r.row_index for r in rows] == list(range(3000))
    assert len(plan.cuts) == buckets - 1


def test_text_and_decimal_keys(spark):
    df = spark.range(500).select(
        F.concat(F.lit("ä'\"\\-"), F.col("id").cast("string")).alias("s"), (F.col("id") / 7).cast("decimal(20,5)").alias("d")
    )
    for keys in (["s"], ["d", "s"]):
        for buckets in (5, 80):
            got = [r[0] for r in plan_rows(df, keys, buckets).index(df).orderBy(*keys).select("row_index").collect()]
            assert got == list(range(500))


def test_one_value_may_hold_most_rows(spark):
    """A hot leading key is cut by the tie-breaker, so no bucket holds it alone."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("hot"))
    plan = plan_rows(df, ["hot", "id"], 20)
    sizes = [b - a for a, b in zip(plan.starts, plan.starts[1:] + [plan.total])]
    assert max(sizes) < 4000 / 20 * 3
    assert plan.index(df).agg(F.sum("row_index")).first()[0] == 4000 * 3999 // 2


def test_repeated_or_missing_keys_are_errors(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"))
    with pytest.raises(ValueError, match="tie-breaker"):
        plan_rows(df, "k", 8)
    with pytest.raises(ValueError, match="complete key"):
        plan_rows(spark.range(1000).select(F.nullif("id", F.lit(5)).alias("k")), "k", 8)


def test_positions_and_slices(spark):
    df = shuffled(spark, 1000)
    plan = plan_rows(df, ["t", "id"], 10)
    order = sorted((r.t, r.id) for r in df.collect())
    at = plan.keys_at(df, [0, 17, 500, 999, 1000])
    assert sorted(at) == [0, 17, 500, 999]
    assert all(int(at[p][1]) == order[p][1] for p in at)
    for offset, limit in [(0, 10), (17, 300), (990, 50), (250, 0), (1000, 5), (2000, 1)]:
        end = offset + limit if limit else None
        assert sorted((r.t, r.id) for r in plan.slice(df, offset, limit).collect()) == order[offset:end]


@pytest.mark.parametrize("offset", [None, "", "abc", "-5", "0", "37", 37, "999", "5000"])
def test_pages(spark, offset):
    df = shuffled(spark, 1000)
    skip = int(offset) if str(offset).isdigit() else 0
    got = [r.id for r in page(df, "id", offset, 100).collect()]
    assert got == list(range(1000))[skip : skip + 100]


def test_pages_in_order_are_one_scan(spark):
    df = shuffled(spark, 1000)
    pages = paginate(df, ["t", "id"], 300).collect()
    assert sorted({r.page for r in pages}) == [0, 1, 2, 3]
    by_page = [sorted((r.t, r.id) for r in pages if r.page == p) for p in range(4)]
    assert [len(p) for p in by_page] == [300, 300, 300, 100]
    assert sum(by_page, []) == sorted((r.t, r.id) for r in df.collect())


def test_resuming_page_by_page_loses_and_repeats_nothing(spark):
    df = shuffled(spark, 200).cache()
    seen, t, last = [], None, None
    while True:
        rows = resume(df, "t", "id", t, last, 45).collect()
        if not rows:
            break
        seen += [(r.t, r.id) for r in rows]
        t, last = str(rows[-1].t), rows[-1].id
    assert seen == sorted((r.t, r.id) for r in df.collect())


def test_bucket_count():
    assert bucket_count(0, 8) == 1
    assert bucket_count(150_000, 8) == 8
    assert bucket_count(10**9, 8) == 1000
    assert bucket_count(10**13, 8) == 16_384


def test_tied_keys_are_errors_at_every_size_and_offset(spark):
    for rows in (40, 9_000):
        df = spark.range(rows).select((F.col("id") % (rows - 1)).alias("k"))
        for offset in (None, "0", "10"):
            with pytest.raises(ValueError, match="tie-breaker"):
                page(df, "k", offset, 10)


def test_more_splits_than_positions_of_a_job(spark):
    df = spark.range(5_000).select(F.col("id").alias("k"))
    tagged = split_by_rows(df, "k", 2_000).groupBy("split_id").count()
    assert tagged.count() == 2_000 and tagged.agg(F.sum("count")).first()[0] == 5_000


def test_ties_are_found_in_the_sort_that_numbers_the_rows(spark):
    """Also where the sample of keys holds no tie, and with no shuffle but that by bucket."""
    df = spark.range(60_000).select(F.when(F.col("id") == 59_999, 7).otherwise(F.col("id")).alias("k"))
    for job in (lambda: paginate(df, "k", 100), lambda: numbered(df, "k")):
        with pytest.raises(Exception, match="tie-breaker"):
            job().collect()
    rows = numbered(spark.range(60_000), "id")
    assert rows.where("row_index != id").isEmpty() and rows.count() == 60_000
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
