"""Projections, predicates, split reads, ordering and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.plans.rows import plan_rows
from headgate.plans.splits import hash_index


def project(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns in source order; unknown names are ignored, an empty request is all."""
    if not wanted:
        return df
    keep = set(wanted)
    return df.select(*[c for c in df.columns if c in keep])


def after_cursor(ts: str, cursor: str | None) -> Column:
    """Strictly after the cursor, read as the column's own type; without one, every row."""
    return F.lit(True) if cursor is None else F.col(ts) > F.lit(cursor)


def in_range(key: str, lo: Column, hi: Column) -> Column:
    """Half-open range predicate."""
    return (F.col(key) >= lo) & (F.col(key) < hi)


def read_range(
    df: DataFrame, key: str, lo: int | None, hi: int | None, columns: list[str] | None = None, nulls: bool = False
) -> DataFrame:
    """One key-range split. A bound left out is not applied; with `nulls`, rows without a key too.

    Of the splits of a plan the first one has these rows.
    """
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (F.col(key) >= F.lit(lo))
    if hi is not None:
        inside = inside & (F.col(key) < F.lit(hi))
    return project(df.where(inside | F.col(key).isNull() if nulls else inside), columns or [])


def tag_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """All hash splits in one pass, the number of the split as a column."""
    return df.withColumn("split_index", hash_index(key, n))


def read_rows(df: DataFrame, keys: str | list[str], offset: int, limit: int) -> DataFrame:
    """One row-number split in key order; limit 0 is unbounded."""
    return plan_rows(df, keys).slice(df, offset, limit)


def read_hash(df: DataFrame, key: str, n: int, i: int) -> DataFrame:
    """One hash split."""
    return df.where(hash_index(key, n) == i)


def below_path(path: str, prefix: str) -> Column:
    """Keys at or below a folder; reaches the scan as a pushed filter.

    A sibling whose name merely begins alike is not below it.
    """
    if prefix.endswith("/"):
        return F.col(path).startswith(prefix)
    return (F.col(path) == prefix) | F.col(path).startswith(f"{prefix}/")


def first_by(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Top-n in ascending order."""
    return df.orderBy(*order).limit(n)


def first_per_group(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ordinal of each group, by partial aggregation, not by a window."""
    rest = [c for c in df.columns if c not in group]
    picked = df.groupBy(*group).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*group, "_row.*").select(*df.columns)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Bag union of split or entity outputs, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)
