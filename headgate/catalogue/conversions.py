"""Conversions and declared schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.functions.values import (
    base_name,
    default_text,
    epoch_micros,
    extension,
    lenient_number,
    parse_list,
    plain_decimal,
    resize_integer,
)
from headgate.operators.envelope import kind_counts
from headgate.operators.schema import (
    Field,
    apply_json_schema,
    apply_schema,
    conformance_report,
    dynamic_to_typed,
    typed_to_dynamic,
)
from headgate.functions.typenames import source_field_type
from headgate.operators.scan import union_all
from headgate.sources.tables import full_scan

KINDS = {
    "orders": {"o_orderkey": "Int64Val", "o_custkey": "Int64Val", "o_orderstatus": "StringVal", "o_totalprice": "DoubleVal",
               "o_orderdate": "TimestampMicros", "o_orderpriority": "StringVal"},
    "nation": {"n_nationkey": "Int32Val", "n_name": "StringVal", "n_regionkey": "Int32Val"},
    "embeddings": {"vec_id": "Int64Val", "embedding": "StringVal", "label": "Int32Val"},
}


@query(
    "c1_cell_kinds",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS entity, '{c}' AS "column", CASE WHEN {c} IS NULL THEN 'NullVal' ELSE '{k}' END AS kind,
            count(*) AS cells FROM {t} GROUP BY 3"""
        for t, columns in KINDS.items()
        for c, k in columns.items()
    ),
)
def _(spark, sd):
    return union_all([kind_counts(full_scan(spark, sd, t)).select(F.lit(t).alias("entity"), "*") for t in KINDS])


@query(
    "c2_plain_decimal",
    r"""
    SELECT c_custkey, regexp_replace(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), '\.?0+$', '') AS acctbal FROM customer
    """,
)
def _(spark, sd):
    exact = F.col("c_acctbal").cast("decimal(12,2)")
    return full_scan(spark, sd, "customer").select("c_custkey", plain_decimal(exact).alias("acctbal"))


@query(
    "c3_epoch_micros",
    """
    SELECT o_orderkey, epoch_us(o_orderdate) AS at_micros, epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS day_micros FROM orders
    """,
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return orders.select(
        "o_orderkey",
        epoch_micros(F.col("o_orderdate"), orders.schema["o_orderdate"].dataType).alias("at_micros"),
        epoch_micros(F.col("day"), orders.schema["day"].dataType).alias("day_micros"),
    )


@query(
    "c4_default_text",
    "SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS price, CAST(o_custkey AS VARCHAR) AS cust FROM orders",
)
def _(spark, sd):
    orders = full_scan(spark, sd, "orders")
    return orders.select(
        "o_orderkey",
        default_text(F.col("o_totalprice"), orders.schema["o_totalprice"].dataType).alias("price"),
        default_text(F.col("o_custkey"), orders.schema["o_custkey"].dataType).alias("cust"),
    )


@query(
    "c5_resize_integer",
    """
    SELECT o_orderkey, TRY_CAST(o_orderkey * 1000000 AS INTEGER) AS narrow, TRY_CAST(o_custkey AS SMALLINT) AS short,
           CAST(o_custkey AS BIGINT) AS wide
    FROM orders
    """,
)
def _(spark, sd):
    return full_scan(spark, sd, "orders").select(
        "o_orderkey",
        resize_integer(F.col("o_orderkey") * 1_000_000, "int").alias("narrow"),
        resize_integer(F.col("o_custkey"), "smallint").alias("short"),
        resize_integer(F.col("o_custkey").cast("int"), "bigint").alias("wide"),
    )


@query(
    "c6_lenient_number",
    r"""
    WITH t AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN ' ' || p_size || ' ' WHEN 1 THEN p_name WHEN 2 THEN '-' || p_size
                 WHEN 3 THEN CAST(p_retailprice AS VARCHAR) ELSE '' END AS raw FROM part)
    SELECT p_partkey,
           CASE WHEN regexp_full_match(trim(raw), '[+-]?\d+') THEN CAST(trim(raw) AS INTEGER) END AS as_int,
           CASE WHEN regexp_full_match(trim(raw), '[+-]?\d+') THEN CAST(trim(raw) AS INTEGER) ELSE 0 END AS as_int_or_zero,
           TRY_CAST(trim(raw) AS DOUBLE) AS as_double
    FROM t
    """,
)
def _(spark, sd):
    size = F.col("p_size").cast("string")
    raw = (
        F.when(F.col("p_size") % 5 == 0, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(F.col("p_size") % 5 == 1, F.col("p_name"))
        .when(F.col("p_size") % 5 == 2, F.concat(F.lit("-"), size))
        .when(F.col("p_size") % 5 == 3, F.col("p_retailprice").cast("string"))
        .otherwise("")
    )
    text = full_scan(spark, sd, "part").select("p_partkey", raw.alias("raw"))
    return text.select(
        "p_partkey",
        lenient_number(F.col("raw")).alias("as_int"),
        lenient_number(F.col("raw"), default_zero=True).alias("as_int_or_zero"),
        lenient_number(F.col("raw"), "double").alias("as_double"),
    )


@query(
    "c7_path_parts",
    r"""
    WITH p AS (SELECT page_id, url, regexp_replace(url, '/+$', '') AS path FROM pages)
    SELECT page_id, regexp_extract(path, '([^/]*)$', 1) AS name, regexp_extract(url, '(\.[^./]*)$', 1) AS extension FROM p
    """,
)
def _(spark, sd):
    url = F.col("url")
    return full_scan(spark, sd, "pages").select(
        "page_id", base_name(url).alias("name"), extension(url).alias("extension")
    )


@query(
    "c8_delimited_list",
    """
    WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, ','), lambda x: trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13)
                 || ' ' || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197)
                 || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288))),
                 lambda x: x <> '' AND x <> 'NULL') AS parts FROM documents)
    SELECT doc_id, CAST(len(parts) AS INTEGER) AS parts, md5(array_to_string(parts, '|')) AS digest FROM l
    """,
)
def _(spark, sd):
    lists = full_scan(spark, sd, "documents").select("doc_id", parse_list(F.col("text")).alias("parts"))
    return lists.select(
        "doc_id",
        F.size("parts").alias("parts"),
        F.md5(F.array_join("parts", "|").cast("binary")).alias("digest"),
    )


@query("y1_apply_schema", "SELECT o_totalprice, o_orderkey, o_orderdate, o_orderstatus, o_custkey, NULL::BOOLEAN AS paid FROM orders")
def _(spark, sd):
    orders = full_scan(spark, sd, "orders")
    text = orders.select(*[F.col(c).cast("string") for c in orders.columns])
    declared = {
        "o_totalprice": "float64",
        "o_orderkey": "int64",
        "o_orderdate": "timestamp",
        "o_orderstatus": "varchar",
        "o_custkey": "bigint",
        "paid": "bool",
    }
    return apply_schema(text, declared)


@query(
    "y1_apply_source_types",
    """
    SELECT CAST(l_linenumber AS SMALLINT) AS l_linenumber, l_orderkey, CAST(l_quantity AS DECIMAL(38,9)) AS l_quantity, l_discount, l_returnflag, l_shipdate
    FROM lineitem
    """,
)
def _(spark, sd):
    lineitem = full_scan(spark, sd, "lineitem")
    text = lineitem.select(*[F.col(c).cast("string") for c in lineitem.columns])
    declared = {
        "l_linenumber": "int2",
        "l_orderkey": "bigint",
        "l_quantity": "numeric",
        "l_discount": "double precision",
        "l_returnflag": "character varying",
        "l_shipdate": "timestamp without time zone",
    }
    return apply_schema(text, declared, source_field_type)


@query(
    "y1_parameterised_types",
    """
    SELECT CAST(l_orderkey AS DECIMAL(38,0)) AS l_orderkey, CAST(l_discount AS DECIMAL(20,13)) AS l_discount, [CAST(l_partkey AS INTEGER), CAST(l_suppkey AS INTEGER), NULL] AS keys,
           [[l_returnflag, 'a, "b"'], [l_linestatus]] AS flags
    FROM lineitem
    """,
)
def _(spark, sd):
    lineitem = full_scan(spark, sd, "lineitem")
    text = lineitem.select(
        F.col("l_orderkey").cast("string"),
        F.col("l_discount").cast("string"),
        F.concat(F.lit("{"), "l_partkey", F.lit(", "), "l_suppkey", F.lit(",NULL}")).alias("keys"),
        F.concat(F.lit("{{"), "l_returnflag", F.lit(r',"a, \"b\""},{'), "l_linestatus", F.lit("}}")).alias("flags"),
    )
    declared = {"l_orderkey": "numeric(38,0)", "l_discount": "numeric(20,13)", "keys": "integer[]", "flags": "text[][]"}
    return apply_schema(text, declared, source_field_type)


@query(
    "y2_dynamic_to_typed",
    r"""
    SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS amount, regexp_replace(CAST(o_totalprice AS VARCHAR), '\.0$', '') AS amount_text,
           o_custkey AS cust, CAST(o_custkey AS DOUBLE) AS cust_number, NULL::INTEGER AS status, NULL::VARCHAR AS absent
    FROM orders
    """,
)
def _(spark, sd):
    row = F.struct(
        F.col("o_totalprice").alias("amount"),
        F.col("o_totalprice").alias("amount_text"),
        F.col("o_custkey").alias("cust"),
        F.col("o_custkey").alias("cust_number"),
        F.col("o_orderstatus").alias("status"),
    )
    rows = full_scan(spark, sd, "orders").select("o_orderkey", F.to_json(row).alias("row"))
    fields = {"amount": "int", "amount_text": "string", "cust": "int64", "cust_number": "double", "status": "int", "absent": "text"}
    return dynamic_to_typed(rows, "row", fields)


@query("y3_typed_to_dynamic", "SELECT * FROM customer")
def _(spark, sd):
    customer = full_scan(spark, sd, "customer")
    fields = {
        "c_custkey": "int64",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    }
    return dynamic_to_typed(typed_to_dynamic(customer), "row", fields)


@query(
    "y4_json_schema",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL::DOUBLE AS weight, NULL::VARCHAR AS note FROM events
    """,
)
def _(spark, sd):
    schema = """{"type": "object", "properties": {"k": {"type": "integer"}, "weight": {"type": "number"}, "note": {"type": "string"}}}"""
    return apply_json_schema(full_scan(spark, sd, "events").select("event_id", "props"), "props", schema)


@query(
    "y5_conformance_report",
    r"""
    SELECT 'event_id' AS "column", 'uncastable' AS rule, 0 AS violations
    UNION ALL SELECT 'event_id', 'null_in_non_null', count(*) FILTER (WHERE event_id IS NULL) FROM events
    UNION ALL SELECT 'ts', 'uncastable', 0
    UNION ALL SELECT 'ts', 'null_in_non_null', count(*) FILTER (WHERE ts IS NULL) FROM events
    UNION ALL SELECT 'user_id', 'uncastable', count(*) FILTER (WHERE user_id > 2147483647) FROM events
    UNION ALL SELECT 'event_type', 'uncastable', count(*) FILTER (WHERE NOT regexp_full_match(event_type, '[+-]?\d+')) FROM events
    UNION ALL SELECT 'value', 'uncastable', count(*) FROM events
    UNION ALL SELECT 'region', 'missing', count(*) FROM events
    UNION ALL SELECT 'props', 'extra', count(*) FROM events
    """,
)
def _(spark, sd):
    declared = [
        Field("event_id", "int64", nullable=False),
        Field("ts", "timestamp", nullable=False),
        Field("user_id", "int"),
        Field("event_type", "int"),
        Field("value", "date"),
        Field("region", "string"),
    ]
    return conformance_report(full_scan(spark, sd, "events"), declared)
