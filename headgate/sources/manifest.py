"""Manifest files: a header, then 13 columns by position, as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.functions.values import blank_to_null, lenient_number, trim_space
from headgate.sources.records import quoted_records

# Column names by position, with type and nullability.
COLUMNS = [
    ("level", "int", False),
    ("parent_pn", "string", True),
    ("part_number", "string", False),
    ("revision", "string", False),
    ("nomenclature", "string", False),
    ("qty", "int", False),
    ("type", "string", False),
    ("material", "string", True),
    ("weight_kg", "double", True),
    ("cage_code", "string", True),
    ("cad_file", "string", True),
    ("linked_document", "string", True),
    ("document_type", "string", True),
]
BAD_LINE = "_bad_line"


def read_manifest(spark: SparkSession, path: str, default_zero: bool = False) -> tuple[DataFrame, DataFrame]:
    """`(rows, rejects)`: trimmed and typed rows, and the raw lines whose width is not the header's.

    Numbers that do not parse are NULL, or 0 with `default_zero`. A file is read by as many tasks as
    it has blocks, also where cells hold line breaks.
    """
    header = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(path).columns
    if len(header) < len(COLUMNS):
        raise ValueError(f"a manifest has {len(COLUMNS)} columns, this one has {len(header)}")
    names = [n for n, _, _ in COLUMNS] + [f"_more{i}" for i in range(len(header) - len(COLUMNS))]
    schema = ", ".join(f"`{n}` STRING" for n in [*names, BAD_LINE])
    # The first record of a file is its header. Options as where a reader takes the file whole: a
    # quote inside quotes is doubled, and a backslash is a character.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "escape": '"'}
    cells = F.from_csv("value", schema, options).alias("cells")
    raw = quoted_records(spark, path).where("NOT first").select("value", cells)
    typed = []
    for name, dtype, nullable in COLUMNS:
        c = F.col("cells")[name]
        if dtype != "string":
            value = lenient_number(c, dtype, default_zero)
        else:
            value = blank_to_null(c) if nullable else F.coalesce(trim_space(c), F.lit(""))
        typed.append(value.alias(name))
    bad = F.col("cells")[BAD_LINE]
    return raw.where(bad.isNull()).select(*typed), raw.where(bad.isNotNull()).select(F.col("value").alias("line"))
