"""Profiles and constraints, verified on the data itself."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headgate.functions.names import column, unused
from headgate.functions.typenames import spark_logical_type
from headgate.operators.scan import union_all
from headgate.plans.statistics import cursor_column


def profile(df: DataFrame, entity: str) -> DataFrame:
    """One row per column: ordinal, types, declared precision and scale, longest text, NULLs.

    One pass over the table, whatever the number of columns.
    """
    measures, rows = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(df.schema.fields):
        c = column(f.name)
        measures.append(F.count(c).alias(f"v{i}"))
        is_text = isinstance(f.dataType, T.StringType)
        if is_text:
            measures.append(F.max(F.length(c)).alias(f"w{i}"))
        exact = f.dataType if isinstance(f.dataType, T.DecimalType) else None
        rows.append(
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(spark_logical_type(f.dataType)).alias("logical_type"),
                F.lit(exact.precision if exact else None).cast("int").alias("precision"),
                F.lit(exact.scale if exact else None).cast("int").alias("scale"),
                (F.col(f"w{i}") if is_text else F.lit(None)).cast("int").alias("max_length"),
                (F.col("n") - F.col(f"v{i}")).alias("null_count"),
            )
        )
    return df.agg(*measures).select(F.lit(entity).alias("entity"), F.array(*rows).alias("fields"))


def profile_rows(df: DataFrame, entity: str) -> DataFrame:
    """The profile, one row per column."""
    return profile(df, entity).select("entity", F.inline("fields"))


@dataclass(frozen=True)
class Constraint:
    """A declared constraint, as it is carried in an entity descriptor."""

    name: str
    type: str
    columns: list[str]
    referenced_table: str | None = None
    referenced_columns: list[str] = field(default_factory=list)
    check: str | None = None


def describe_entity(
    df: DataFrame, entity: str, namespace: str, primary_key: list[str], constraints: list[Constraint] | None = None
) -> DataFrame:
    """One nested descriptor: fields in order with what was measured, keys, constraints, abilities."""
    try:
        cursor = cursor_column(df)
    except ValueError:
        cursor = None
    declared = [
        F.struct(
            F.lit(c.name).alias("name"),
            F.lit(c.type).alias("type"),
            F.array(*[F.lit(x) for x in c.columns]).cast("array<string>").alias("columns"),
            F.lit(c.referenced_table).cast("string").alias("referenced_table"),
            F.array(*[F.lit(x) for x in c.referenced_columns]).cast("array<string>").alias("referenced_columns"),
            F.lit(c.check).cast("string").alias("check"),
        )
        for c in constraints or []
    ]
    empty = "array<struct<name:string,type:string,columns:array<string>,referenced_table:string,referenced_columns:array<string>,check:string>>"
    return profile(df, entity).select(
        "entity",
        F.lit(f"{namespace}_{entity}_v1").alias("schema_id"),
        "fields",
        F.array(*[F.lit(k) for k in primary_key]).cast("array<string>").alias("primary_key"),
        F.array(*declared).cast(empty).alias("constraints"),
        F.lit(cursor).cast("string").alias("cursor_column"),
        F.lit(cursor is not None).alias("has_cursor"),
    )


def key_report(df: DataFrame, keys: list[str], entity: str) -> DataFrame:
    """Whether the columns are a primary key: one row of counts.

    Rows are counted per key before anything is compared, so a repeated key is never gathered.
    """
    absent, copies = unused(df, "_absent"), unused(df, "_n")
    missing = reduce(Column.__or__, [column(k).isNull() for k in keys])
    per_key = df.withColumn(absent, missing).groupBy(*map(column, keys), absent).agg(F.count(F.lit(1)).alias(copies))
    return per_key.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col(copies) > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col(absent), F.col(copies))), F.lit(0)).alias("null_rows"),
    ).select(
        F.lit(entity).alias("entity"),
        F.lit(",".join(keys)).alias("key"),
        "*",
        ((F.col("repeated_keys") == 0) & (F.col("null_rows") == 0)).alias("is_key"),
    )


def duplicates(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys that break uniqueness, optionally among the rows of a partial index; NULL keys never clash."""
    rows = df if where is None else df.where(where)
    there = reduce(Column.__and__, [column(k).isNotNull() for k in keys])
    return rows.where(there).groupBy(*map(column, keys)).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


@dataclass(frozen=True)
class ForeignKey:
    """Child columns that must be found in the parent columns."""

    name: str
    child: DataFrame
    child_keys: list[str]
    parent: DataFrame
    parent_keys: list[str]


def orphans(fk: ForeignKey) -> DataFrame:
    """Child keys without a parent, and how many rows hold each; NULL keys pass.

    Both sides are counted per key in one aggregation. An anti-join would be moved below the
    counting by the optimizer, and then a hot key would be shuffled row by row.
    """
    names = [f"k{i}" for i in range(len(fk.child_keys))]

    def keys_of(df: DataFrame, keys: list[str], child: int) -> DataFrame:
        columns = [column(c).alias(n) for c, n in zip(keys, names)]
        return df.select(*columns, F.lit(child).alias("_child"), F.lit(1 - child).alias("_parent")).dropna(subset=names)

    both = keys_of(fk.child, fk.child_keys, 1).unionByName(keys_of(fk.parent, fk.parent_keys, 0))
    per_key = both.groupBy(*names).agg(F.sum("_child").alias("rows"), F.sum("_parent").alias("_parents"))
    return per_key.where((F.col("_parents") == 0) & (F.col("rows") > 0)).drop("_parents")


def foreign_key_report(keys: list[ForeignKey]) -> DataFrame:
    """Orphan keys and rows per relationship, zero included."""
    return union_all(
        [
            orphans(fk)
            .agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"))
            .select(F.lit(fk.name).alias("relationship"), "orphan_keys", "orphan_rows")
            for fk in keys
        ]
    )


def check_violations(df: DataFrame, check: Column) -> DataFrame:
    """Rows for which the check is false; NULL passes."""
    return df.where(~check)


@dataclass(frozen=True)
class Relation:
    """How rows of one table lead to rows of another: `table` holds both keys.

    A foreign key leads from parent to child in the child's table. A link table may repeat a
    pair, so its pairs are made distinct. A key is a column or, in order, several.
    """

    src_entity: str
    dst_entity: str
    table: DataFrame
    src_key: str | list[str]
    dst_key: str | list[str]
    link: bool = False


def node_key(key: str | list[str]) -> Column:
    """The text that names a row by its key; null if a part of it is.

    One column is its own text. Several are each its length, a colon and its text, one after the
    other, so that no two tuples have one name, whatever characters they hold.
    """
    if isinstance(key, str):
        return column(key).cast("string")
    parts = [column(k).cast("string") for k in key]
    return F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


def relationship_edges(relations: list[Relation]) -> DataFrame:
    """`(src_entity, src_key, dst_entity, dst_key)` of all relations; rows with a null in a key have no edge."""
    parts = []
    for r in relations:
        texts = [node_key(r.src_key).alias("s"), node_key(r.dst_key).alias("d")]
        keys = [k for key in (r.src_key, r.dst_key) for k in ([key] if isinstance(key, str) else key)]
        table = r.table.select(*[column(k) for k in dict.fromkeys(keys)])
        # Whole numbers have one text each, so they are made distinct before they become texts.
        whole = r.link and all(isinstance(f.dataType, T.IntegralType) for f in table.schema.fields)
        table = table.distinct() if whole else table
        pairs = table.select(*texts).dropna()
        pairs = pairs.distinct() if r.link and not whole else pairs
        parts.append(
            pairs.select(
                F.lit(r.src_entity).alias("src_entity"),
                F.col("s").alias("src_key"),
                F.lit(r.dst_entity).alias("dst_entity"),
                F.col("d").alias("dst_key"),
            )
        )
    return union_all(parts)
