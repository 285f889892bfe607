"""Sources beyond plain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.functions.values import exact_sum
from headgate.operators.scan import union_all
from headgate.plans.splits import range_splits
from headgate.session import workspace
from headgate.sources.jdbc import range_predicates
from headgate.sources.manifest import COLUMNS, read_manifest
from headgate.sources.tables import full_scan


@query(
    "s6_jdbc_predicates",
    """
    WITH b AS (SELECT min(o_orderkey) mn, max(o_orderkey) mx FROM orders)
    SELECT CAST(least((o_orderkey - mn) // greatest((mx - mn + 1) // 8, 1), 7) AS INTEGER) AS partition, count(*) AS row_count,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders, b GROUP BY 1
    """,
)
def _(spark, sd):
    """The predicates that a relational read sends, one per connection, applied to the same table."""
    orders = full_scan(spark, sd, "orders")
    predicates = range_predicates(range_splits(orders, "o_orderkey", 8))
    return union_all(
        [
            orders.where(p.replace('"', "`")).agg(
                F.lit(i).alias("partition"), F.count(F.lit(1)).alias("row_count"), exact_sum(F.col("o_totalprice")).alias("total")
            )
            for i, p in enumerate(predicates)
        ]
    )


def manifest_cells(name):
    """The cells of a part's line, with its nomenclature."""
    key = F.col("p_partkey").cast("string")
    parent = F.when(F.col("p_partkey") > 0, F.expr("p_partkey div 10").cast("string")).otherwise("")
    return [
        F.length(key).cast("string"),
        parent,
        key,
        F.col("p_brand"),
        name,
        F.when(F.col("p_size") == 13, "n/a").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"))),
        F.col("p_type"),
        F.lit(" "),
        F.when(F.col("p_size") == 14, "").otherwise(F.col("p_retailprice").cast("string")),
        F.lit(""),
        F.concat(F.lit("part-"), key, F.lit(".step")),
        F.lit(""),
        F.lit("drawing"),
    ]


def written_manifest(spark, sd) -> str:
    """A manifest file written from the parts; lines of size 50 are cut short."""
    cells = manifest_cells(F.concat(F.lit("  "), "p_name", F.lit(" ")))
    line = F.when(F.col("p_size") == 50, F.concat_ws(",", *cells[:5])).otherwise(F.concat_ws(",", *cells))
    header = ",".join(name for name, _, _ in COLUMNS)
    path = workspace(spark, "manifest")
    writer = full_scan(spark, sd, "part").select(line.alias(header)).write.option("header", "true")
    # A separator that never occurs makes each line one unquoted cell, below the header.
    writer = writer.option("sep", "\u0001").option("ignoreLeadingWhiteSpace", "false")
    writer.option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


@query(
    "s7_manifest_rows",
    """
    SELECT CAST(length(CAST(p_partkey AS VARCHAR)) AS INTEGER) AS level, CASE WHEN p_partkey > 0 THEN CAST(p_partkey // 10 AS VARCHAR) END AS parent_pn,
           CAST(p_partkey AS VARCHAR) AS part_number, p_brand AS revision, p_name AS nomenclature,
           CASE WHEN p_size <> 13 THEN p_size END AS qty, p_type AS type, NULL::VARCHAR AS material,
           CASE WHEN p_size <> 14 THEN p_retailprice END AS weight_kg, NULL::VARCHAR AS cage_code,
           'part-' || p_partkey || '.step' AS cad_file, NULL::VARCHAR AS linked_document, 'drawing' AS document_type
    FROM part WHERE p_size <> 50
    """,
)
def _(spark, sd):
    return read_manifest(spark, written_manifest(spark, sd))[0]


@query(
    "s7_manifest_rejects",
    """
    SELECT length(CAST(p_partkey AS VARCHAR)) || ',' || CASE WHEN p_partkey > 0 THEN CAST(p_partkey // 10 AS VARCHAR) ELSE '' END
           || ',' || p_partkey || ',' || p_brand || ',  ' || p_name || ' ' AS line
    FROM part WHERE p_size = 50
    """,
)
def _(spark, sd):
    return read_manifest(spark, written_manifest(spark, sd))[1]


@query(
    "s7_manifest_quoted",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS part_number, CASE WHEN p_size <> 13 THEN p_size END AS qty, CASE WHEN p_size <> 14 THEN p_retailprice END AS weight_kg,
           p_brand || ', "' || p_type || '"' || chr(10) || chr(10) || p_name || chr(10) || ',"' AS nomenclature
    FROM part
    """,
)
def _(spark, sd):
    """Names in quotes that hold commas, quotes, line breaks and empty lines; files are read in many blocks."""
    text = F.concat("p_brand", F.lit(', "'), "p_type", F.lit('"\n\n'), "p_name", F.lit('\n,"'))
    cells = [c.alias(name) for c, (name, _, _) in zip(manifest_cells(text), COLUMNS, strict=True)]
    path = workspace(spark, "manifest-quoted")
    full_scan(spark, sd, "part").select(*cells).write.option("header", "true").option("escape", '"').csv(path)
    rows, _ = read_manifest(spark, path)
    return rows.select("part_number", "qty", "weight_kg", "nomenclature")
