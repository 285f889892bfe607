"""Rows joined to the ranges that hold them, whatever the widths and overlaps.

The bounds of all ranges cut the axis into segments, and within a segment the same ranges hold. A row is
in one segment: the one that begins with the last cut at or below its key. That cut is found by sorting
rows and cuts together, in pieces between literal cuts, each piece dealt out over as many tasks as its rows
ask for, the few cuts of it being copied instead. A range is a run of segments; only segments that have
rows are numbered, so listing the run of every range makes no more pairs than the join has rows, and a
row is never copied. Segments with very many rows are split the same way before they meet their ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headgate.functions.names import column
from headgate.plans.rows import RowPlan, plan_rows
from headgate.plans.search import literal_longs
from headgate.session import save_table, workspace

#: Rows that one task sorts or joins: at least and at most.
LEAST_ROWS, MOST_ROWS = 5_000, 500_000


def share(rows: int, parallelism: int) -> int:
    """Rows for a task, so that there are a few tasks for every core."""
    return min(max(rows // (4 * parallelism), LEAST_ROWS), MOST_ROWS)


def _spread(parts: Column) -> Column:
    """A number below `parts` that deals rows out evenly, equal ones too."""
    return F.pmod(F.monotonically_increasing_id(), parts)


def as_of(rows: DataFrame, key: str, cuts: DataFrame, plan: RowPlan, values: list[str]) -> DataFrame:
    """`_row`, and the `values` (BIGINT) of the last of `cuts` (`cut`, values) at or below the row's key; null before the first.

    `plan` has the literal cuts between which rows and cuts are sorted together. Rows without a key
    are left out. The driver sees a few numbers for each of the plan's buckets.
    """
    packed = rows.where(column(key).isNotNull()).select(column(key).cast("bigint").alias("cut"), F.struct("*").alias("_row"))
    buckets = len(plan.cuts) + 1
    counts = {r["b"]: r["n"] for r in packed.groupBy(plan.bucket().alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    most = share(sum(counts.values()), rows.sparkSession.sparkContext.defaultParallelism)
    parts = literal_longs([max(1, -(-counts.get(b, 0) // most)) for b in range(buckets)])
    ends = {r["b"]: r["v"] for r in cuts.groupBy(plan.bucket().alias("b")).agg(F.max_by(F.struct(*values), "cut").alias("v")).collect()}
    carried, last = [], None
    for b in range(buckets):
        carried.append(last)
        last = ends.get(b, last)
    carry = F.struct(*[F.get(literal_longs([c and c[v] for c in carried]), F.col("_b")).alias(v) for v in values])
    none = F.lit(None).cast(packed.schema["_row"].dataType)
    left = packed.select("cut", plan.bucket().alias("_b"), "_row", F.lit(None).cast(f"struct<{', '.join(f'{v}: bigint' for v in values)}>").alias("_v"), F.lit(1).alias("_kind"))
    left = left.withColumn("_part", _spread(F.get(parts, F.col("_b"))))
    right = cuts.select("cut", plan.bucket().alias("_b"), none.alias("_row"), F.struct(*[F.col(v).cast("bigint").alias(v) for v in values]).alias("_v"), F.lit(0).alias("_kind"))
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.get(parts, F.col("_b")) - 1)))
    before = Window.partitionBy("_b", "_part").orderBy("cut", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = left.unionByName(right).withColumn("_v", F.coalesce(F.last("_v", ignorenulls=True).over(before), carry))
    return found.where("_kind = 1").select("_row", *[F.col(f"_v.{v}").alias(v) for v in values])


def _numbered(cuts: DataFrame, segments: DataFrame, plan: RowPlan, most: int) -> tuple[DataFrame, int]:
    """`cut, n, at, parts`: with every cut the rows of its segment, how many segments with rows are before it, and how many parts it is split in; and the number of segments."""
    flagged = cuts.join(segments, "cut", "left").withColumn("_b", plan.bucket())
    per = {r["_b"]: r["n"] for r in flagged.groupBy("_b").agg(F.count("n").alias("n")).collect()}
    starts, total = [], 0
    for b in range(len(plan.cuts) + 1):
        starts.append(total)
        total += per.get(b, 0)
    before = Window.partitionBy("_b").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    at = F.get(literal_longs(starts), F.col("_b")) + F.coalesce(F.count("n").over(before), F.lit(0))
    return flagged.select("cut", "n", at.alias("at"), F.ceil(F.col("n") / most).cast("bigint").alias("parts")), total


def interval_join(df: DataFrame, key: str, ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """Rows joined to every range with `lo <= key < hi` (BIGINT; a NULL `hi` is open).

    Rows without a key, ranges without a `lo` and empty ranges join nothing.
    """
    spark = df.sparkSession
    held = ranges.where(column(lo).isNotNull() & (column(hi).isNull() | (column(lo) < column(hi))))
    held = held.select(column(lo).cast("bigint").alias("_lo"), column(hi).cast("bigint").alias("_hi"), F.struct("*").alias("_range"))
    bounds = reduce(DataFrame.union, [held.select(F.col(c).alias("cut")) for c in ("_lo", "_hi")])
    cuts = save_table(bounds.where("cut IS NOT NULL").distinct(), workspace(spark, "cuts"))
    plan = plan_rows(cuts, "cut", unique=False)
    segments = as_of(df.select(column(key)), key, cuts.withColumn("seg", F.col("cut")), plan, ["seg"])
    segments = segments.where("seg IS NOT NULL").groupBy(F.col("seg").alias("cut")).agg(F.count(F.lit(1)).alias("n"))
    segments = save_table(segments, workspace(spark, "segments"))
    rows = segments.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    numbered, total = _numbered(cuts, segments, plan, share(rows, spark.sparkContext.defaultParallelism))
    numbered = save_table(numbered, workspace(spark, "numbered"))
    filled = numbered.where("n IS NOT NULL").select("cut", "at", "parts")
    placed = as_of(df, key, filled, plan, ["at", "parts"]).where("at IS NOT NULL")
    placed = placed.select("_row", F.col("at").alias("_at"), _spread(F.col("parts")).alias("_part"))
    first = numbered.select(F.col("cut").alias("_lo"), F.col("at").alias("_first"))
    end = numbered.select(F.col("cut").alias("_hi"), F.col("at").alias("_end"))
    runs = held.join(first, "_lo").join(end, "_hi", "left").select("_range", "_first", F.coalesce("_end", F.lit(total)).alias("_end"))
    listed = runs.where("_first < _end").select("_range", F.explode(F.expr("sequence(_first, _end - 1)")).alias("_at"))
    parts = filled.select(F.col("at").alias("_at"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("_part"))
    return placed.join(listed.join(parts, "_at"), ["_at", "_part"]).select("_row.*", "_range.*")
