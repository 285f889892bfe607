"""Splits of a table for parallel extraction.

A split is a number in a column: no row moves, the tag is computed in the scan. Only the
statistics row and the split bounds (by default at most `MAX_SPLITS`) are known to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headgate.functions.values import exact_sum
from headgate.plans.rows import plan_rows
from headgate.plans.search import count_cuts_at_or_below, key_types
from headgate.plans.statistics import TableStats, collect_stats

# Defaults of the split-count rule, and the strategy names.
ROWS_PER_SPLIT = 1_000_000
MIN_SPLITS = 1
MAX_SPLITS = 32
DEFAULT_PARALLELISM = 4
PRIMARY_KEY = "primary_key"
ROW_NUMBER = "row_number"
MODULO = "modulo"

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
LONG_MAX = (1 << 63) - 1


def split_count(rows: int, desired: int = DEFAULT_PARALLELISM, target: int = ROWS_PER_SPLIT, most: int = MAX_SPLITS) -> int:
    """One split up to `target` rows; beyond it the desired number, else one per `target` rows, and `most` at most."""
    if rows <= target:
        return MIN_SPLITS
    wanted = desired if desired > 0 else -(-rows // target)
    return max(MIN_SPLITS, min(most, wanted))


def choose_strategy(dtype: T.DataType | None) -> str:
    """Ranges for an integer key, row numbers for everything else."""
    return PRIMARY_KEY if isinstance(dtype, INTEGER_TYPES) else ROW_NUMBER


def split_name(index: Column) -> Column:
    return F.concat(F.lit("split-"), F.lpad(index.cast("string"), 4, "0"))


@dataclass(frozen=True)
class RangeSplits:
    """Equal-width key ranges `[min + i*width, min + (i+1)*width)`; the last ends after the maximum."""

    key: str
    min_key: int
    max_key: int
    row_count: int
    n: int

    @property
    def width(self) -> int:
        return max((self.max_key - self.min_key + 1) // self.n, 1)

    def bounds(self) -> list[tuple[int, int]]:
        edges = [self.min_key + i * self.width for i in range(self.n)]
        return [(lo, self.max_key + 1 if i == self.n - 1 else lo + self.width) for i, lo in enumerate(edges)]

    def index(self) -> Column:
        wide = self.max_key - self.min_key >= LONG_MAX
        key = f"CAST(`{self.key}` AS {'DECIMAL(20,0)' if wide else 'BIGINT'})"
        steps = F.expr(f"({key} - ({self.min_key})) div {self.width}")
        return F.least(F.coalesce(steps.cast("int"), F.lit(0)), F.lit(self.n - 1))  # null keys: the first split

    def _described(self, index: Column) -> list[Column]:
        """Id, range and estimated rows of a split, from its number.

        The last `hi` is NULL, so unbounded, when the largest key is the largest BIGINT.
        """
        lo = (F.lit(self.min_key) + index.cast("decimal(20,0)") * F.lit(self.width)).cast("bigint")
        end = self.max_key + 1 if self.max_key < LONG_MAX else None
        hi = F.when(index == self.n - 1, F.lit(end).cast("bigint")).otherwise(lo + F.lit(self.width))
        estimate = F.lit(self.row_count // self.n).cast("bigint")
        return [split_name(index).alias("split_id"), lo.alias("lo"), hi.alias("hi"), estimate.alias("estimated_rows")]

    def plan(self, spark: SparkSession) -> DataFrame:
        """One row per split: id, index, range, estimated rows and descriptive metadata."""
        index = F.col("id").cast("int")
        rows = spark.range(0, self.n, 1, 1).select(index.alias("split_index"), *self._described(index))
        return rows.withColumn(
            "metadata",
            F.create_map(
                F.lit("strategy"), F.lit(PRIMARY_KEY),
                F.lit("column"), F.lit(self.key),
                F.lit("min_value"), F.col("lo").cast("string"),
                F.lit("max_value"), F.col("hi").cast("string"),
                F.lit("split_index"), F.col("split_index").cast("string"),
            ),
        )

    def report(self, df: DataFrame, amount: str) -> DataFrame:
        """Actual against planned rows, key bounds and a total per split; empty splits are kept.

        One partial aggregation: every split contributes an empty row of its own, so no join with
        the plan is needed.
        """
        key = F.col(self.key)
        rows = df.select(self.index().alias("i"), key.alias("k"), F.col(amount).alias("v"), F.lit(1).alias("one"))
        empty = df.sparkSession.range(0, self.n, 1, 1).select(
            F.col("id").cast("int").alias("i"),
            F.lit(None).cast(df.schema[self.key].dataType).alias("k"),
            F.lit(None).cast(df.schema[amount].dataType).alias("v"),
            F.lit(0).alias("one"),
        )
        actual = (
            rows.unionByName(empty)
            .groupBy("i")
            .agg(
                F.sum("one").alias("row_count"),
                F.min("k").alias("min_key"),
                F.max("k").alias("max_key"),
                exact_sum(F.col("v")).alias("total"),
            )
        )
        return actual.select(*self._described(F.col("i")), "row_count", "min_key", "max_key", "total")


def range_splits(df: DataFrame, key: str, n: int, stats: TableStats | None = None) -> RangeSplits:
    """Plan equal-width ranges; an empty table or a single key value is one split."""
    stats = stats or collect_stats(df, key)
    if stats.row_count == 0:
        return RangeSplits(key, 0, 0, 0, 1)
    if stats.min_key >= stats.max_key:
        n = 1
    return RangeSplits(key, stats.min_key, stats.max_key, stats.row_count, n)


def split_by_range(df: DataFrame, key: str, n: int) -> DataFrame:
    """`df` with `split_id` by equal-width ranges of an integer key; other keys split by rows."""
    if not isinstance(df.schema[key].dataType, INTEGER_TYPES):
        return split_by_rows(df, key, n)
    return df.withColumn("split_id", split_name(range_splits(df, key, n).index()))


def row_split_bounds(rows: int, n: int) -> list[tuple[int, int]]:
    """`(offset, rows)` of each row-number split; the last takes the remainder."""
    per = rows // n
    return [(i * per, per if i < n - 1 else rows - i * per) for i in range(n)]


def split_by_rows(df: DataFrame, keys: str | list[str], n: int) -> DataFrame:
    """`df` with `split_id` by equal row counts in key order.

    The exact keys at the split edges are looked up first, so tagging the rows needs no shuffle.
    """
    plan = plan_rows(df, keys)
    edges = [offset for offset, _ in row_split_bounds(plan.total, n)][1:]
    at = plan.keys_at(df, edges)
    cuts = [at[e] for e in edges if e in at]
    index = count_cuts_at_or_below(plan.keys, key_types(df, plan.keys), cuts)
    return df.withColumn("split_id", split_name(index))


def portable_hash(key: str) -> Column:
    """Non-negative hash of the key's text that any engine can repeat: 8 hex digits of its MD5."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_index(key: str, n: int) -> Column:
    """Number of the hash split; rows without a key are in the first."""
    return F.coalesce(F.pmod(portable_hash(key), F.lit(n)).cast("int"), F.lit(0))


def split_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.withColumn("split_id", split_name(hash_index(key, n)))
