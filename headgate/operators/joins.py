"""Join shapes: chains and array membership.

No join here forces a broadcast of data. Spark broadcasts a side when its known size is below
`spark.sql.autoBroadcastJoinThreshold`; otherwise the join is a shuffle join, in which adaptive
execution splits partitions that a hot key makes too large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def join_chain(base: DataFrame, *steps: tuple[DataFrame, dict[str, str]], how: str = "inner") -> DataFrame:
    """Equi-joins one after the other; each step maps left columns to columns of its table."""
    for other, on in steps:
        condition = reduce(Column.__and__, [F.col(a) == other[b] for a, b in on.items()])
        base = base.join(other, condition, how)
    return base


def left_chain_counts(
    parent: DataFrame, key: str, child: DataFrame, child_key: str, child_fk: str, grand: DataFrame, grand_fk: str
) -> DataFrame:
    """Parents left-joined to children and grandchildren, counted per parent.

    Each level is counted before it is joined, so no join multiplies rows and a hot key is
    already a single row when it is shuffled.
    """
    per_child = grand.groupBy(F.col(grand_fk).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    children = child.select(child_key, child_fk).join(per_child, F.col(child_key) == F.col("_c"), "left")
    per_parent = children.groupBy(F.col(child_fk).alias("_p")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("_n").alias("grandchildren")
    )
    return (
        parent.select(key)
        .join(per_parent, F.col(key) == F.col("_p"), "left")
        .select(
            key,
            F.coalesce("children", F.lit(0)).cast("bigint").alias("children"),
            F.coalesce("grandchildren", F.lit(0)).cast("bigint").alias("grandchildren"),
        )
    )


def array_members(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per distinct element of the row's array, as column `name`."""
    return df.withColumn(name, F.explode(F.array_distinct(array))).drop(array)


def array_member_join(df: DataFrame, array: str, other: DataFrame, key: str) -> DataFrame:
    """Rows joined to every row of `other` whose key is in their array; a repeated element counts once."""
    return array_members(df, array, "_m").join(other, F.col("_m") == other[key]).drop("_m")


def array_member_counts(df: DataFrame, array: str, other: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Rows of `other` with how many arrays name them, and further measures of those rows.

    Elements are aggregated before the join, so a popular element is one row when it is shuffled.
    """
    counted = array_members(df, array, "_m").groupBy("_m").agg(F.count(F.lit(1)).alias("mentions"), *measures)
    return other.join(counted, other[key] == F.col("_m")).drop("_m")
