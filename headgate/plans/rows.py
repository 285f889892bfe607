"""Row positions in key order without a single-task window.

A bounded sample of keys gives literal cut points, one keys-only pass counts the rows between
them, and the running totals say at which position each bucket starts. From there

* the position of every row needs one shuffle by bucket (`numbered`, `RowPlan.index`);
* the key at a given position needs only the bucket that holds it (`RowPlan.keys_at`);
* a page or a row-number split is a key range (`RowPlan.slice`), which the scan can prune.

The cuts are literals, so a recomputed task puts every row where the first attempt put it.
The ordering columns together must be unique and non-null; add a tie-breaker when one column
is not (for files, `_metadata.file_path` and `_metadata.row_index` always serve). Keys that repeat
are found while the rows between the cuts are counted, or, where every row gets its position
anyway, while these are sorted: the keys are read twice, for the sample and for the counts.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headgate.plans.search import (
    count_cuts_at_or_below,
    key_between,
    key_struct,
    key_text,
    key_types,
    literal_longs,
)

ROWS_PER_BUCKET = 1_000_000
MIN_ROWS_PER_BUCKET = 2_000
MAX_BUCKETS = 16_384
SAMPLE_PER_BUCKET = 24
SAMPLE_SEED = 20_240_101
MAX_POSITIONS = 1_024


@dataclass(frozen=True)
class RowPlan:
    keys: list[str]
    types: list[T.DataType]
    cuts: list[tuple[str, ...]]
    starts: list[int]
    total: int
    #: Whether it is known that no key repeats; if not, `index` finds it out.
    unique: bool = True

    def bucket(self) -> Column:
        return count_cuts_at_or_below(self.keys, self.types, self.cuts)

    def index(self, df: DataFrame, name: str = "row_index") -> DataFrame:
        """`df` with the 0-based position of every row in key order."""
        within = Window.partitionBy("_bucket").orderBy(*self.keys)
        position = F.get(literal_longs(self.starts), F.col("_bucket")) + F.row_number().over(within) - 1
        if not self.unique:
            # Keys that tie are neighbours in the sort that the positions need anyway.
            tied = F.lag(key_struct(self.keys)).over(within) == key_struct(self.keys)
            position = F.when(tied, F.raise_error(F.lit(_repeats(self.keys))).cast("bigint")).otherwise(position)
        return df.withColumn("_bucket", self.bucket()).withColumn(name, position).drop("_bucket")

    def _bucket_bounds(self, bucket: int) -> tuple[tuple[str, ...] | None, tuple[str, ...] | None]:
        lo = self.cuts[bucket - 1] if bucket > 0 else None
        hi = self.cuts[bucket] if bucket < len(self.cuts) else None
        return lo, hi

    def keys_at(self, df: DataFrame, positions: list[int]) -> dict[int, tuple[str, ...]]:
        """Key text at each position that exists; reads and sorts only the buckets concerned."""
        wanted = sorted({p for p in positions if 0 <= p < self.total})
        if not wanted:
            return {}
        if len(wanted) > MAX_POSITIONS:  # so many to a job; an expression lists their buckets
            parts = [wanted[i : i + MAX_POSITIONS] for i in range(0, len(wanted), MAX_POSITIONS)]
            return {p: key for part in parts for p, key in self.keys_at(df, part).items()}
        buckets = sorted({bisect_right(self.starts, p) - 1 for p in wanted})
        ranges = [key_between(self.keys, self.types, *self._bucket_bounds(b)) for b in buckets]
        near = df.select(*self.keys).where(reduce(Column.__or__, ranges))
        found = self.index(near, "_pos").where(F.col("_pos").isin(wanted))
        return {r["_pos"]: tuple(r[k] for k in self.keys) for r in found.select("_pos", *key_text(self.keys)).collect()}

    def slices(self, df: DataFrame, parts: list[tuple[int, int]]) -> list[DataFrame]:
        """For each `(offset, limit)` those rows in key order, as a key range; limit 0 is unbounded."""
        ends = [(max(o, 0), max(o, 0) + n if n > 0 else self.total) for o, n in parts]
        at = self.keys_at(df, [p for span in ends for p in span])
        return [
            df.where(key_between(self.keys, self.types, at[o] if o > 0 else None, at.get(end)))
            if o < self.total
            else df.where(F.lit(False))
            for o, end in ends
        ]

    def slice(self, df: DataFrame, offset: int, limit: int) -> DataFrame:
        return self.slices(df, [(offset, limit)])[0]


def bucket_count(rows: int, parallelism: int) -> int:
    """Buckets for `rows`: about a million rows each, but enough to keep the cluster busy."""
    by_size = -(-rows // ROWS_PER_BUCKET)
    by_cores = min(parallelism, rows // MIN_ROWS_PER_BUCKET)
    return max(1, min(MAX_BUCKETS, max(by_size, by_cores)))


def _repeats(keys: list[str]) -> str:
    return f"{keys} repeats; row positions need a tie-breaker"


def plan_rows(df: DataFrame, keys: str | list[str], buckets: int | None = None, unique: bool = True) -> RowPlan:
    """Cut points and bucket positions of `df` in key order.

    The driver receives one key and one count per bucket, whatever the size of the table. Keys that
    repeat raise; without `unique` the plan is for `index` alone, which raises then.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    types = key_types(df, keys)
    narrow = df.select(*keys)
    total = narrow.count()
    n = bucket_count(total, df.sparkSession.sparkContext.defaultParallelism) if buckets is None else buckets
    cuts = _sample_cuts(narrow, keys, n, total) if 1 < n < total else []

    # The rows are counted again so that all positions come from one reading.
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    rows = narrow.select(count_cuts_at_or_below(keys, types, cuts).alias("_bucket"), missing.alias("_missing"), *keys)
    # Over all keys, at every size: among rows that tie no position is the right one.
    same = rows.groupBy("_bucket", "_missing", *(keys if unique else [])).agg(F.count(F.lit(1)).alias("n"))
    nulls = F.sum(F.when(F.col("_missing"), F.col("n")))
    per_bucket = same.groupBy("_bucket").agg(F.sum("n").alias("n"), F.max("n").alias("most"), nulls.alias("nulls")).collect()
    if any(r["nulls"] for r in per_bucket):
        raise ValueError(f"rows without a value in {keys}; row positions need a complete key")
    if unique and any(r["most"] > 1 for r in per_bucket):
        raise ValueError(_repeats(keys))
    counts = {r["_bucket"]: r["n"] for r in per_bucket}
    sizes = [counts.get(b, 0) for b in range(len(cuts) + 1)]
    return RowPlan(keys, types, cuts, list(accumulate(sizes, initial=0))[:-1], sum(sizes), unique)


def numbered(df: DataFrame, keys: str | list[str], name: str = "row_index") -> DataFrame:
    """`df` with the 0-based position of every row in key order; keys that repeat end the job."""
    return plan_rows(df, keys, unique=False).index(df, name)


def _sample_cuts(narrow: DataFrame, keys: list[str], n: int, total: int) -> list[tuple[str, ...]]:
    """`n - 1` keys that cut the table into about equal parts; only they reach the driver."""
    sampled = narrow.dropna().sample(min(1.0, n * SAMPLE_PER_BUCKET / total), SAMPLE_SEED)
    # The sample is one array of about n * SAMPLE_PER_BUCKET keys, however large the table is.
    ordered = sampled.agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("s"), F.count(F.lit(1)).alias("n"))
    size = F.col("n").cast("int")
    rank = F.sequence(F.lit(1), F.lit(n - 1))
    picks = F.transform(rank, lambda i: F.get(F.col("s"), (i.cast("bigint") * size / F.lit(n)).cast("int")))
    repeats = F.exists(F.sequence(F.lit(1), size - 1), lambda i: F.get(F.col("s"), i) == F.get(F.col("s"), i - 1))
    found = ordered.select(
        "n",
        F.when(size > 1, repeats).otherwise(F.lit(False)).alias("repeats"),
        F.when(size >= n, picks).otherwise(F.col("s")).alias("cuts"),
    ).select("repeats", F.transform("cuts", lambda c: F.struct(*[c[k].cast("string").alias(k) for k in keys])).alias("cuts"))
    row = found.first()
    if row["repeats"]:
        raise ValueError(_repeats(keys))
    return [tuple(c) for c in row["cuts"]]


def page(df: DataFrame, keys: str | list[str], offset: str | int | None = None, limit: int = 10_000) -> DataFrame:
    """One page in key order. The offset counts only when it is an integer above 0.

    A deep page is read as a key range instead of being sorted out from all rows before it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    try:
        skip = max(int(offset or 0), 0)
    except ValueError:
        skip = 0
    return plan_rows(df, keys).slice(df, skip, limit).orderBy(*keys)


def paginate(df: DataFrame, keys: str | list[str], size: int) -> DataFrame:
    """`df` with the page number of every row; the pages in order are one full scan."""
    return numbered(df, keys, "_pos").withColumn("page", F.expr(f"_pos div {size}")).drop("_pos")
