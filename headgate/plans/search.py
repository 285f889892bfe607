"""Locating a row among sorted literal cut points, in O(log cuts) per row."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key columns are carried to the driver and back as text, so only types whose text casts
# back to the same value can order rows.
ORDERABLE = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
    T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType,
)


# Below this many cuts the search is a tree of comparisons, which Spark compiles.
SMALL = 48


def key_types(df: DataFrame, keys: list[str]) -> list[T.DataType]:
    types = [df.schema[k].dataType for k in keys]
    for key, dtype in zip(keys, types):
        if not isinstance(dtype, ORDERABLE):
            raise TypeError(f"{key} of type {dtype.simpleString()} cannot order rows")
    return types


def key_struct(keys: list[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def key_text(keys: list[str]) -> list[Column]:
    return [F.col(k).cast("string").alias(k) for k in keys]


def key_literals(values: tuple[str, ...], types: list[T.DataType]) -> list[Column]:
    return [F.lit(v).cast(t) for v, t in zip(values, types)]


def literal_longs(values: list[int]) -> Column:
    """A constant array, handed over as one JSON literal that the optimizer folds."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _at_or_above(keys: list[str], bound: list[Column]) -> Column:
    """`keys >= bound` by plain column comparisons."""
    c, b = F.col(keys[0]), bound[0]
    if len(keys) == 1:
        return c >= b
    return (c > b) | ((c == b) & _at_or_above(keys[1:], bound[1:]))


def _search_tree(keys: list[str], bounds: list[list[Column]], lo: int, hi: int) -> Column:
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(_at_or_above(keys, bounds[mid]), _search_tree(keys, bounds, mid + 1, hi)).otherwise(
        _search_tree(keys, bounds, lo, mid)
    )


def count_cuts_at_or_below(keys: list[str], types: list[T.DataType], cuts: list[tuple[str, ...]]) -> Column:
    """How many of the sorted `cuts` are <= the row's key: the row's bucket number."""
    if len(cuts) < SMALL:
        bounds = [key_literals(cut, types) for cut in cuts]
        return _search_tree(keys, bounds, 0, len(cuts))
    as_text = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in keys]))
    typed = T.ArrayType(T.StructType([T.StructField(k, t) for k, t in zip(keys, types)]))
    body = json.dumps([dict(zip(keys, cut)) for cut in cuts])
    table = F.from_json(F.lit(body), as_text).cast(typed)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    row_key = key_struct(keys)

    def advance(pos: Column, step: Column) -> Column:
        reachable = (pos + step) <= F.lit(len(cuts))
        return F.when(reachable & (F.get(table, pos + step - 1) <= row_key), pos + step).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def key_between(
    keys: list[str],
    types: list[T.DataType],
    lo: tuple[str, ...] | None,
    hi: tuple[str, ...] | None,
) -> Column:
    """`lo <= key < hi`, open where a bound is None.

    For composite keys the bound on the first column is stated as well, so that the scan can
    prune by it.
    """
    cond = F.lit(True)
    if lo is not None:
        bound = key_literals(lo, types)
        cond = cond & (F.col(keys[0]) >= bound[0]) & _at_or_above(keys, bound)
    if hi is not None:
        bound = key_literals(hi, types)
        cond = cond & (F.col(keys[0]) <= bound[0]) & ~_at_or_above(keys, bound)
    return cond
