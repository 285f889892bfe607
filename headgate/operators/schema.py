"""Declared schemas applied to rows, and what does not fit them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headgate.functions.fitting import fitted, json_value_as
from headgate.functions.names import column, quoted, unused
from headgate.functions.typenames import field_type, struct_from_json_schema


def _json_path(name: str) -> str:
    """Path of one field, dots and blanks being part of its name."""
    return f"$['{name}']" if "'" not in name else f'$["{name}"]'


def apply_schema(df: DataFrame, fields: dict[str, str], resolve: Callable[[str], str] = field_type) -> DataFrame:
    """Select and cast to declared types, in declared order.

    A column that is absent, or a value that does not fit, is NULL.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (fitted(column(name), present[name], resolve(t)) if name in present else F.lit(None).cast(resolve(t))).alias(name)
            for name, t in fields.items()
        ]
    )


def dynamic_to_typed(df: DataFrame, source: str, fields: dict[str, str]) -> DataFrame:
    """Typed columns from a column of JSON objects.

    Missing, null and unfitting values are NULL; numbers cross-cast, truncating toward zero;
    any value can become text.
    """
    parsed = df.withColumn("_row", F.try_parse_json(F.col(source)))
    others = [quoted(c) for c in df.columns if c != source]
    texts = parsed.select(*others, *[F.try_variant_get("_row", _json_path(name), "string").alias(name) for name in fields])
    typed = [json_value_as(column(name), field_type(t)).alias(name) for name, t in fields.items()]
    return texts.select(*others, *typed)


def typed_to_dynamic(df: DataFrame, name: str = "row") -> DataFrame:
    """Every row as one JSON object; NULL cells are kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def apply_json_schema(df: DataFrame, source: str, json_schema: str) -> DataFrame:
    """Typed columns from JSON text under a JSON schema; all columns are nullable."""
    struct = struct_from_json_schema(json_schema)
    row = unused(df, "_row")
    parsed = df.withColumn(row, F.from_json(column(source), struct))
    return parsed.select(*[quoted(c) for c in df.columns if c != source], f"{row}.*")


@dataclass(frozen=True)
class Field:
    """A declared column."""

    name: str
    type: str
    nullable: bool = True


def does_not_fit(c: Column, dtype: T.DataType, to: str) -> Column:
    """The value is there, but not as the declared type."""
    if dtype.simpleString() == to:
        return F.lit(False)
    return c.isNotNull() & fitted(c, dtype, to).isNull()


def conformance_report(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Violations per column and rule in one pass: missing, extra, uncastable, null_in_non_null.

    For a missing or extra column the count is the number of rows.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    checks: list[tuple[str, str, Column]] = []
    for f in fields:
        to = field_type(f.type)
        if f.name not in present:
            checks.append((f.name, "missing", F.lit(True)))
            continue
        c = column(f.name)
        checks.append((f.name, "uncastable", does_not_fit(c, present[f.name], to)))
        if not f.nullable:
            checks.append((f.name, "null_in_non_null", c.isNull()))
    declared = {f.name for f in fields}
    checks += [(name, "extra", F.lit(True)) for name in present if name not in declared]
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(col).alias("column"), F.lit(rule).alias("rule"), F.col(f"c{i}").alias("violations"))
                    for i, (col, rule, _) in enumerate(checks)
                ]
            )
        )
    )


def fallback_report(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Per column: cells, and cells that do not fit the declared Spark type, in one pass."""
    aggs = []
    for i, (name, to) in enumerate(declared.items()):
        aggs += [
            F.count(column(name)).alias(f"n{i}"),
            F.count_if(does_not_fit(column(name), df.schema[name].dataType, to)).alias(f"b{i}"),
        ]
    return df.agg(*aggs).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column"),
                        F.lit(to).alias("declared"),
                        F.col(f"n{i}").alias("cells"),
                        F.col(f"b{i}").alias("fallbacks"),
                    )
                    for i, (name, to) in enumerate(declared.items())
                ]
            )
        )
    )
