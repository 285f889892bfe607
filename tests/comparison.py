"""Run a query and its SQL side by side and compare names, types and the bag of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def oracle(sd: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sd}/{t}.parquet')")
    return con


def cell(v: object) -> object:
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list):
        return tuple(cell(x) for x in v)
    return v


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree."""
    cur = con.execute(sql)
    expected_names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    actual = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(expected_names):
        return [f"columns {sorted(df.columns)} against {sorted(expected_names)}"]
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows against {len(expected)}")
    a, e = bag(df.columns, actual), bag(expected_names, expected)
    if a != e:
        only_a, only_e = list((a - e).items())[:3], list((e - a).items())[:3]
        problems.append(f"only here: {only_a}; only in SQL: {only_e}")
    kinds = {d[0]: str(d[1]) for d in con.execute(sql).description}
    for name, spark_type in df.dtypes:
        if not same_type(spark_type, kinds[name]):
            problems.append(f"{name}: {spark_type} against {kinds[name]}")
    return problems


SAME = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "smallint": {"SMALLINT"},
    "double": {"DOUBLE"},
    "float": {"FLOAT"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
    "date": {"DATE"},
}


def same_type(spark_type: str, duck_type: str) -> bool:
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "") == duck_type.upper().replace(" ", "")
    return duck_type in SAME.get(spark_type, {duck_type})
