"""The shape of physical plans: what is pushed down, what is shuffled, what stays in the JVM."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from headgate import catalogue
from headgate.operators.incremental import incremental, resume
from headgate.operators.intervals import interval_join
from headgate.operators.scan import below_path, first_per_group, read_range
from headgate.plans.rows import plan_rows
from headgate.plans.splits import split_by_hash, split_by_range, split_by_rows
from headgate.sources.tables import full_scan

PYTHON_QUERIES = {"s11_user_source", "u1_batch_callback"}


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def exchanges(plan: str) -> int:
    """Shuffles in the plan tree, the details below it left out."""
    return len(re.findall(r"^[ :*+-]*Exchange \(", plan, re.MULTILINE))


@pytest.fixture(scope="module")
def orders(spark, sd):
    return full_scan(spark, sd, "orders")


def test_range_reads_reach_the_scan(orders):
    plan = plan_of(read_range(orders, "o_orderkey", 100, 200, ["o_totalprice", "o_orderkey"]))
    assert "GreaterThanOrEqual(o_orderkey,100)" in plan and "LessThan(o_orderkey,200)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_cursor_reaches_the_scan_and_limit_is_a_top_n(spark, sd):
    plan = plan_of(incremental(full_scan(spark, sd, "events"), "ts", "2024-01-10", 5))
    assert "GreaterThan(ts,2024-01-10T00:00)" in plan and "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_keyset_bound_reaches_the_scan(orders):
    plan = plan_of(resume(orders, "o_orderdate", "o_orderkey", "1998-01-01", 5, 10))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan and "TakeOrderedAndProject" in plan


def test_prefix_reaches_the_scan(spark, sd):
    assert "StringStartsWith(url,https://)" in plan_of(full_scan(spark, sd, "pages").where(below_path("url", "https://")))


def test_a_row_slice_is_a_pushed_range(orders):
    plan = plan_rows(orders, "o_orderkey", 8).slice(orders, 300, 100)
    assert "GreaterThanOrEqual(o_orderkey,300)" in plan_of(plan) and "Exchange" not in plan_of(plan)


@pytest.mark.parametrize("tag", [split_by_range, split_by_rows, split_by_hash])
def test_tagging_splits_moves_no_row(orders, tag):
    plan = plan_of(tag(orders, "o_orderkey", 4))
    assert "Exchange" not in plan and "Window" not in plan


def test_row_index_has_no_single_task_window(orders):
    plan = plan_of(plan_rows(orders, ["o_orderdate", "o_orderkey"], 8).index(orders))
    assert "SinglePartition" not in plan and exchanges(plan) == 1


def test_first_row_per_group_is_an_aggregate(orders):
    plan = plan_of(first_per_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert "Window" not in plan and exchanges(plan) == 1 and "partial_min_by" in plan


def test_orphans_are_counted_before_they_are_shuffled(spark, sd):
    plan = plan_of(entry.queries()["k4_orphans"](spark, sd))
    assert "Join" not in plan and exchanges(plan) == 1 and "partial_sum" in plan


def test_intervals_are_an_equi_join(spark, sd):
    ranges = spark.range(50).select(F.col("id").alias("r"), (F.col("id") * 3).alias("lo"), (F.col("id") * 3 + 9).alias("hi"))
    plan = plan_of(interval_join(full_scan(spark, sd, "lineitem").select("l_partkey"), "l_partkey", ranges, "lo", "hi"))
    assert "HashJoin" in plan or "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", sorted(n for n in catalogue.QUERIES if not re.match("t[0-9]", n) and n not in PYTHON_QUERIES))
def test_no_query_leaves_the_jvm_or_multiplies_tables(name, spark, sd):
    plan = plan_of(entry.queries()[name](spark, sd))
    for shape in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert shape not in plan
