"""Type names, declared schemas and JSON schemas as Spark types."""

from __future__ import annotations

import json
import re

from pyspark.sql import types as T

# Names a declared field may use, and the Spark type of each.
FIELD_TYPES = {
    "string": "string",
    "varchar": "string",
    "text": "string",
    "int": "int",
    "integer": "int",
    "int32": "int",
    "bigint": "bigint",
    "int64": "bigint",
    "float": "float",
    "float32": "float",
    "double": "double",
    "float64": "double",
    "boolean": "boolean",
    "bool": "boolean",
    "timestamp": "timestamp_ntz",
    "date": "date",
    "binary": "binary",
    "bytes": "binary",
}

# Exact source type names, and the logical type of each.
SOURCE_TYPES = {
    "integer": "INTEGER",
    "int4": "INTEGER",
    "bigint": "BIGINT",
    "int8": "BIGINT",
    "smallint": "SMALLINT",
    "int2": "SMALLINT",
    "real": "FLOAT",
    "float4": "FLOAT",
    "double precision": "DOUBLE",
    "float8": "DOUBLE",
    "boolean": "BOOLEAN",
    "bool": "BOOLEAN",
    "date": "DATE",
    "time": "TIME",
    "time without time zone": "TIME",
    "timestamp": "TIMESTAMP",
    "timestamp without time zone": "TIMESTAMP",
    "timestamp with time zone": "TIMESTAMP_WITH_TZ",
    "timestamptz": "TIMESTAMP_WITH_TZ",
    "uuid": "UUID",
    "json": "JSON",
    "jsonb": "JSONB",
    "numeric": "DECIMAL",
    "decimal": "DECIMAL",
    "bytea": "BINARY",
}

# The Spark type that stores each logical type; the others are text.
LOGICAL_TO_SPARK = {
    "SMALLINT": "smallint",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP_WITH_TZ": "timestamp",
    "DECIMAL": "decimal(38,9)",
    "BINARY": "binary",
}

# The logical type of each Spark type; decimals and nested types are told by class.
SPARK_TO_LOGICAL = {
    "tinyint": "SMALLINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP_WITH_TZ",
    "binary": "BINARY",
    "variant": "JSON",
}

# Scalar types of a JSON schema.
JSON_TYPES = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}


# Shapes of source type names with parameters.
NUMERIC = re.compile(r"(?:numeric|decimal)\s*\(\s*([0-9]+)\s*(?:,\s*(-?[0-9]+)\s*)?\)", re.IGNORECASE)
PARAMETERS = re.compile(r"\s*\([^)]*\)")


def logical_type(source_type: str) -> str:
    """Logical type of a source type name: exact names first, then the shape of the name."""
    if source_type in SOURCE_TYPES:
        return SOURCE_TYPES[source_type]
    if NUMERIC.fullmatch(source_type):
        return "DECIMAL"
    if "char" in source_type:
        return "STRING"
    if "[]" in source_type:
        return "ARRAY"
    if source_type != "text" and " " not in source_type:
        return "ENUM"
    return "TEXT"


def field_type(name: str) -> str:
    """Spark type of a declared field; an unknown name is text."""
    return FIELD_TYPES.get(name, "string")


def source_field_type(name: str) -> str:
    """Spark type of a source column, by its name with precision, scale, length and array marks.

    A `numeric(p, s)` that Spark's decimals cannot hold is text, so that no digit is lost. A bare
    `numeric` has no bounds; it gets nine decimals, and a value that does not fit them is NULL.
    """
    name = name.strip()
    if name.endswith("[]"):
        return f"array<{source_field_type(name[:-2])}>"
    if exact := NUMERIC.fullmatch(name):
        precision, scale = int(exact[1]), int(exact[2] or 0)
        return f"decimal({precision},{scale})" if 0 <= scale <= precision <= 38 and precision else "string"
    plain = " ".join(PARAMETERS.sub("", name).split())
    return LOGICAL_TO_SPARK.get(logical_type(plain.lower() if plain.lower() in SOURCE_TYPES else plain), "string")


def spark_logical_type(dtype: T.DataType) -> str:
    """Logical type of a column."""
    if isinstance(dtype, T.DecimalType):
        return "DECIMAL"
    if isinstance(dtype, T.ArrayType):
        return "ARRAY"
    return SPARK_TO_LOGICAL.get(dtype.simpleString(), "STRING")


def struct_from_json_schema(text: str) -> T.StructType:
    """Row type of a JSON schema: scalar properties, all nullable, in declared order."""
    properties = json.loads(text).get("properties")
    if not isinstance(properties, dict):
        raise ValueError("a JSON schema needs a 'properties' object")
    ddl = []
    for name, spec in properties.items():
        if not isinstance(spec, dict):
            continue
        if spec.get("type") not in JSON_TYPES:
            raise ValueError(f"unsupported JSON type for {name}: {spec.get('type')}")
        ddl.append(f"`{name}` {JSON_TYPES[spec['type']]}")
    return T.StructType.fromDDL(", ".join(ddl))
