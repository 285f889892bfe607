"""Counts, ordered text aggregation and extraction metrics.

All of them are partial aggregations: what is shuffled is one row per group and task, so a
label that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.functions.values import exact_sum, ntz_micros
from headgate.operators.scan import union_all
from headgate.plans.rows import numbered


def entity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table; answered from file footers where the format has them."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("entity"), "row_count") for name, df in tables.items()]
    )


def _literal(text: str) -> str:
    """Text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ordered_text(df: DataFrame, group: list[str], value: str, order: str, name: str, sep: str = ",") -> DataFrame:
    """One delimited text per group, in order.

    The text is one cell, so this is for groups known to be small (the columns of a key, the
    nations of a region). `ordered_text_parts` serves groups of any size.
    """
    text = F.expr(f"listagg(`{value}`, {_literal(sep)}) WITHIN GROUP (ORDER BY `{order}`)")
    return df.groupBy(*group).agg(text.alias(name))


def ordered_text_parts(
    df: DataFrame, group: list[str], value: str, order: list[str], name: str, size: int = 10_000, sep: str = ","
) -> DataFrame:
    """The delimited text of every group in parts of at most `size` values.

    A group's parts in the order of `part`, joined by `sep`, are its whole text. The values are
    numbered by their position in the order of all groups, which no hot group can make a single
    task of. `group` and `order` together must be unique.
    """
    rows = numbered(df, [*group, *order], "_pos")
    text = F.expr(f"listagg(`{value}`, {_literal(sep)}) WITHIN GROUP (ORDER BY `_pos`)")
    return rows.groupBy(*group, F.expr(f"_pos div {size}").alias("part")).agg(text.alias(name))


def counters(df: DataFrame, labels: list[str], size: Column, failed: Column) -> DataFrame:
    """Records, bytes and errors per label set."""
    return df.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes"),
        F.count_if(failed).alias("errors"),
    )


def histogram(df: DataFrame, labels: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative buckets, sum and count per label set, one row per bound and one for +Inf.

    A missing value is in no bucket and no sum; NaN is in the last bucket and makes the sum NaN.
    """
    c = F.col(value)
    wide = df.groupBy(*labels).agg(
        *[F.count_if(c <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
        exact_sum(c).alias("sum"),
        F.count(c).alias("count"),
    )
    rows = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"b{i}").alias("bucket")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("bucket")))
    return wide.select(*labels, "sum", "count", F.inline(F.array(*rows)))


def active_gauge(df: DataFrame, labels: list[str], started: Column, ended: Column) -> DataFrame:
    """Starts minus ends per label set."""
    change = F.when(started, 1).when(ended, -1).otherwise(0)
    return df.groupBy(*labels).agg(F.sum(change).cast("bigint").alias("active"))


def throughput(df: DataFrame, labels: list[str], ts: str, size: Column) -> DataFrame:
    """Records, bytes and records per second of the time between first and last record."""
    grouped = df.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(size.cast("bigint")).alias("bytes"),
        (ntz_micros(F.max(ts)) - ntz_micros(F.min(ts))).alias("micros"),
    )
    rate = F.col("records") / F.nullif(F.col("micros"), F.lit(0)) * F.lit(1e6)
    return grouped.select(*labels, "records", "bytes", F.round(rate, 6).alias("records_per_second"))
