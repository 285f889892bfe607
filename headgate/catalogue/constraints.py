"""Profiles and constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from headgate.catalogue import query
from headgate.operators.constraints import (
    Constraint,
    ForeignKey,
    Relation,
    check_violations,
    describe_entity,
    duplicates,
    foreign_key_report,
    key_report,
    orphans,
    profile_rows,
    relationship_edges,
)
from headgate.operators.graph import group_report, manifest_walk, resume_traversal, traverse
from headgate.operators.scan import union_all
from headgate.session import workspace
from headgate.sources.tables import full_scan

PROFILED = {
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
}


LOGICAL = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "STRING", "timestamp_ntz": "TIMESTAMP"}


def _profile_sql() -> str:
    rows = []
    for table, columns in PROFILED.items():
        for i, (name, dtype) in enumerate(columns.items(), 1):
            longest = f"CAST(max(length({name})) AS INTEGER)" if dtype == "string" else "NULL::INTEGER"
            rows.append(
                f"""SELECT '{table}' AS entity, {i} AS ordinal, '{name}' AS "column", '{dtype}' AS type,
                    '{LOGICAL[dtype]}' AS logical_type, NULL::INTEGER AS precision, NULL::INTEGER AS scale, {longest} AS max_length, count(*) - count({name}) AS null_count FROM {table}"""
            )
    return " UNION ALL ".join(rows)


@query("k1_column_profile", _profile_sql())
def _(spark, sd):
    return union_all([profile_rows(full_scan(spark, sd, t), t) for t in PROFILED])


CONSTRAINTS = {
    "orders": [Constraint("orders_customer", "FOREIGN KEY", ["o_custkey"], "customer", ["c_custkey"])],
    "documents": [Constraint("length", "CHECK", ["n_chars"], check="n_chars >= 0")],
}


@query(
    "k1_entity_descriptor",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS entity, 'shop_{t}_v1' AS schema_id, {"true" if "timestamp_ntz" in c.values() else "false"} AS has_cursor,
            {"'o_orderdate'" if t == "orders" else "NULL::VARCHAR"} AS cursor_column, '{next(iter(c))}' AS primary_key,
            '{",".join(x.type for x in CONSTRAINTS.get(t, []))}' AS constraints,
            '{",".join(f"{n}:{LOGICAL[d]}" for n, d in c.items())}' AS columns,
            {" + ".join(f"count(*) - count({n})" for n in c)} AS nulls FROM {t}"""
        for t, c in PROFILED.items()
    ),
)
def _(spark, sd):
    nested = union_all(
        [
            describe_entity(full_scan(spark, sd, t), t, "shop", [next(iter(c))], CONSTRAINTS.get(t))
            for t, c in PROFILED.items()
        ]
    )
    named = F.transform("fields", lambda f: F.concat_ws(":", f["column"], f["logical_type"]))
    return nested.select(
        "entity",
        "schema_id",
        "has_cursor",
        "cursor_column",
        F.array_join("primary_key", ",").alias("primary_key"),
        F.array_join("constraints.type", ",").alias("constraints"),
        F.array_join(named, ",").alias("columns"),
        F.aggregate("fields", F.lit(0).cast("bigint"), lambda n, f: n + f["null_count"]).alias("nulls"),
    )


def _key_sql(table: str, keys: list[str]) -> str:
    by = ", ".join(keys)
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""
    SELECT '{table}' AS entity, '{",".join(keys)}' AS key, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
           count(*) FILTER (WHERE n > 1) AS repeated_keys,
           CAST(coalesce(sum(n) FILTER (WHERE {missing}), 0) AS BIGINT) AS null_rows,
           count(*) FILTER (WHERE n > 1 OR {missing}) = 0 AS is_key
    FROM (SELECT {by}, count(*) AS n FROM {table} GROUP BY {by})
    """


KEYS = {
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "conversations": ["conv_id", "turn"],
    "events": ["user_id"],
}


@query("k2_primary_keys", " UNION ALL ".join(_key_sql(t, k) for t, k in KEYS.items()))
def _(spark, sd):
    return union_all([key_report(full_scan(spark, sd, t), k, t) for t, k in KEYS.items()])


@query("k3_unique_violations", "SELECT p_name, count(*) AS copies FROM part GROUP BY p_name HAVING count(*) > 1")
def _(spark, sd):
    return duplicates(full_scan(spark, sd, "part"), ["p_name"])


@query(
    "k3_partial_unique_violations",
    "SELECT p_name, count(*) AS copies FROM part WHERE p_size > 25 GROUP BY p_name HAVING count(*) > 1",
)
def _(spark, sd):
    return duplicates(full_scan(spark, sd, "part"), ["p_name"], F.col("p_size") > 25)


def foreign_keys(spark, sd) -> list[ForeignKey]:
    def t(name):
        return full_scan(spark, sd, name)

    return [
        ForeignKey("orders_customer", t("orders"), ["o_custkey"], t("customer"), ["c_custkey"]),
        ForeignKey("lineitem_orders", t("lineitem"), ["l_orderkey"], t("orders"), ["o_orderkey"]),
        ForeignKey("orders_lineitem", t("orders"), ["o_orderkey"], t("lineitem"), ["l_orderkey"]),
        ForeignKey("labels_documents", t("labels"), ["doc_id"], t("documents"), ["doc_id"]),
        ForeignKey("documents_labels", t("documents"), ["doc_id"], t("labels"), ["doc_id"]),
    ]


def _orphan_sql(name: str, child: str, child_key: str, parent: str, parent_key: str) -> str:
    return f"""
    SELECT '{name}' AS relationship, count(DISTINCT {child_key}) AS orphan_keys, count(*) AS orphan_rows FROM {child}
    WHERE {child_key} IS NOT NULL AND {child_key} NOT IN (SELECT {parent_key} FROM {parent} WHERE {parent_key} IS NOT NULL)
    """


@query(
    "k4_foreign_keys",
    " UNION ALL ".join(
        [
            _orphan_sql("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
            _orphan_sql("lineitem_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            _orphan_sql("orders_lineitem", "orders", "o_orderkey", "lineitem", "l_orderkey"),
            _orphan_sql("labels_documents", "labels", "doc_id", "documents", "doc_id"),
            _orphan_sql("documents_labels", "documents", "doc_id", "labels", "doc_id"),
        ]
    ),
)
def _(spark, sd):
    return foreign_key_report(foreign_keys(spark, sd))


@query(
    "k4_orphans",
    'SELECT o_orderkey AS k0, count(*) AS "rows" FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1',
)
def _(spark, sd):
    return orphans(
        ForeignKey(
            "orders_lineitem",
            full_scan(spark, sd, "orders"),
            ["o_orderkey"],
            full_scan(spark, sd, "lineitem"),
            ["l_orderkey"],
        )
    )


@query("k5_check_violations", "SELECT * FROM lineitem WHERE NOT (l_discount <= 0.05)")
def _(spark, sd):
    return check_violations(full_scan(spark, sd, "lineitem"), F.col("l_discount") <= 0.05)


def shop_edges(spark, sd):
    def t(name):
        return full_scan(spark, sd, name)

    return relationship_edges(
        [
            Relation("region", "nation", t("nation"), "n_regionkey", "n_nationkey"),
            Relation("nation", "customer", t("customer"), "c_nationkey", "c_custkey"),
            Relation("nation", "supplier", t("supplier"), "s_nationkey", "s_suppkey"),
            Relation("customer", "orders", t("orders"), "o_custkey", "o_orderkey"),
            Relation("orders", "part", t("lineitem"), "l_orderkey", "l_partkey", link=True),
        ]
    )


def regions_as_roots(spark, sd):
    key = F.col("r_regionkey").cast("string")
    return full_scan(spark, sd, "region").select(F.lit("region").alias("entity"), key.alias("key"), key.alias("group_id"))


EDGES_SQL = """
    SELECT 'region' AS src_entity, CAST(n_regionkey AS VARCHAR) AS src_key, 'nation' AS dst_entity, CAST(n_nationkey AS VARCHAR) AS dst_key FROM nation
    UNION ALL SELECT 'nation', CAST(c_nationkey AS VARCHAR), 'customer', CAST(c_custkey AS VARCHAR) FROM customer
    UNION ALL SELECT 'nation', CAST(s_nationkey AS VARCHAR), 'supplier', CAST(s_suppkey AS VARCHAR) FROM supplier
    UNION ALL SELECT 'customer', CAST(o_custkey AS VARCHAR), 'orders', CAST(o_orderkey AS VARCHAR) FROM orders
    UNION ALL SELECT DISTINCT 'orders', CAST(l_orderkey AS VARCHAR), 'part', CAST(l_partkey AS VARCHAR) FROM lineitem
"""
REACHED_SQL = f"""
    WITH RECURSIVE edges AS ({EDGES_SQL}),
    reach(entity, key, group_id, depth) AS (
      SELECT 'region', CAST(r_regionkey AS VARCHAR), CAST(r_regionkey AS VARCHAR), 0 FROM region
      UNION
      SELECT dst_entity, dst_key, group_id, depth + 1 FROM reach JOIN edges ON entity = src_entity AND key = src_key WHERE depth < 4),
    nodes AS (SELECT entity, key, group_id, min(depth) AS depth FROM reach GROUP BY entity, key, group_id)
"""


@query("k6_relationship_edges", EDGES_SQL)
def _(spark, sd):
    return shop_edges(spark, sd)


@query(
    "k6_composite_edges",
    """
    SELECT 'orders' AS src_entity, CAST(l_orderkey AS VARCHAR) AS src_key, 'lineitem' AS dst_entity,
           length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey || length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber AS dst_key
    FROM lineitem
    """,
)
def _(spark, sd):
    lineitem = full_scan(spark, sd, "lineitem")
    return relationship_edges([Relation("orders", "lineitem", lineitem, "l_orderkey", ["l_orderkey", "l_linenumber"])])


@query("g1_traverse", f"{REACHED_SQL} SELECT entity, key, min(depth) AS depth FROM nodes GROUP BY entity, key")
def _(spark, sd):
    return traverse(shop_edges(spark, sd), regions_as_roots(spark, sd), 4).select("entity", "key", "depth")


@query(
    "g2_group_report",
    f"{REACHED_SQL} SELECT group_id, count(*) AS nodes, max(depth) AS deepest, max(depth) < 4 AS completed FROM nodes GROUP BY group_id",
)
def _(spark, sd):
    return group_report(traverse(shop_edges(spark, sd), regions_as_roots(spark, sd), 4, by_group=True), 4)


@query("g3_resume_traversal", f"{REACHED_SQL} SELECT entity, key, group_id, depth FROM nodes")
def _(spark, sd):
    state = workspace(spark, "traverse")
    traverse(shop_edges(spark, sd), regions_as_roots(spark, sd), 1, state, by_group=True)
    return resume_traversal(spark, state, 1, 4, by_group=True)


@query(
    "g4_manifest_walk",
    """
    WITH RECURSIVE m AS (SELECT p_partkey AS part_number, CASE WHEN p_partkey > 0 THEN p_partkey // 10 END AS parent_pn,
                           length(CAST(p_partkey AS VARCHAR)) AS level FROM part),
    walk(part_number, root, depth) AS (
      SELECT part_number, CAST(part_number AS VARCHAR), 0 FROM m WHERE parent_pn IS NULL
      UNION ALL SELECT m.part_number, root, depth + 1 FROM walk JOIN m ON m.parent_pn = walk.part_number)
    SELECT m.part_number, parent_pn, CAST(level AS INTEGER) AS level, depth AS walk_level, root, coalesce(level = depth, false) AS level_ok
    FROM m LEFT JOIN walk USING (part_number)
    """,
)
def _(spark, sd):
    key = F.col("p_partkey")
    manifest = full_scan(spark, sd, "part").select(
        key.alias("part_number"),
        F.when(key > 0, F.expr("p_partkey div 10")).alias("parent_pn"),
        F.length(key.cast("string")).alias("level"),
    )
    return manifest_walk(manifest, "part_number", "parent_pn", "level")
