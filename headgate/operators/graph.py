"""Bounded traversal of related records, level by level.

Edges and levels are tables below one state folder, bucketed alike: edges by the node they lead from,
levels by node. A level joins the frontier with its edges, and what that reaches, once deduplicated, with
what was visited, bucket by bucket: what moves is the frontier and the nodes it reaches, never the edges
or the visited set. A node with very many edges is split, its edges lying in several buckets, and is then
copied for each of them when it is in the frontier. The driver learns only which tables a level has nodes
of. The state folder is also what a later run resumes from: the visited set may be far too large for a
token.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.functions.names import column
from headgate.functions.tokens import encode_token, parse_token
from headgate.session import Files, save_table, settings, workspace

NODE_SCHEMA = "entity STRING, key STRING, group_id STRING, depth INT"
#: Edges from one node that are kept together.
HOT_EDGES = 1_000_000
#: With this a table that is bucketed by node needs no shuffle to be joined by node and group.
SUBSET_OF_KEYS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def _node(entity: Column, key: Column) -> Column:
    """One text for a node; no two nodes have the same."""
    return F.concat(F.length(entity).cast("string"), F.lit(":"), entity, key)


class State:
    """The tables of a state folder, known to the session's catalog for as long as they are used."""

    def __init__(self, spark: SparkSession, path: str, depth: int):
        self.spark, self.path = spark, path
        row = spark.read.schema("buckets INT, split BOOLEAN").json(f"{path}/settings").first()
        self.buckets, self.split = row["buckets"], row["split"]
        name = uuid.uuid4().hex
        self.nodes, self.edges = f"headgate_nodes_{name}", f"headgate_edges_{name}"
        self._create(self.nodes, "node STRING, entity STRING, key STRING, group_id STRING, depth INT", "depth", "node", "nodes")
        self._create(self.edges, "bucket_key STRING, dst_entity STRING, dst_key STRING, src_entity STRING", "src_entity", "bucket_key", "edges")
        for d in range(depth + 1):
            spark.sql(f"ALTER TABLE {self.nodes} ADD IF NOT EXISTS PARTITION (depth = {d})")
        spark.sql(f"ALTER TABLE {self.edges} RECOVER PARTITIONS")

    def _create(self, name: str, columns: str, folder: str, by: str, at: str) -> None:
        path = f"{self.path}/{at}".replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({folder}) CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def level(self, depth: int) -> DataFrame:
        return self.spark.table(self.nodes).where(F.col("depth") == depth)

    def visited(self, depth: int) -> DataFrame:
        return self.spark.table(self.nodes).where(F.col("depth") <= depth)

    def write_level(self, nodes: DataFrame, depth: int) -> list[str]:
        """Write one level; the names of the tables it has nodes of, none when it is empty."""
        nodes.select("node", "entity", "key", "group_id").createOrReplaceTempView(view := f"{self.nodes}_new")
        # What a run that failed here has left; a table that is read cannot be overwritten.
        Files(self.spark, self.path).remove(f"{self.path}/nodes/depth={depth}")
        self.spark.sql(f"INSERT INTO {self.nodes} PARTITION (depth = {depth}) SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)
        return self.entities(depth)

    def entities(self, depth: int) -> list[str]:
        return [r[0] for r in self.level(depth).select("entity").distinct().collect()]

    def frontier(self, depth: int) -> DataFrame:
        """The nodes of a level with the keys that their edges are bucketed by."""
        nodes = self.level(depth).select(F.col("node").alias("bucket_key"), "group_id")
        if not self.split:
            return nodes
        hot = self.spark.read.parquet(f"{self.path}/hot").withColumnRenamed("node", "bucket_key")
        parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1)
        nodes = nodes.join(hot, "bucket_key", "left").withColumn("part", F.explode(parts))
        return nodes.select(_part("bucket_key", "part").alias("bucket_key"), "group_id")


def _part(node: str, part: str) -> Column:
    """The bucket key of a part of a node's edges; the first part has the node's own."""
    return F.when(F.col(part) == 0, F.col(node)).otherwise(F.concat(F.col(part).cast("string"), F.lit("/"), F.col(node)))


@contextmanager
def opened(spark: SparkSession, path: str, depth: int) -> Iterator[State]:
    state = State(spark, path, depth)
    try:
        with settings(spark, SUBSET_OF_KEYS):
            yield state
    finally:
        for table in (state.nodes, state.edges):
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay


def _write_edges(edges: DataFrame, path: str, hot_edges: int) -> None:
    """The edges by the table and the node they lead from, and what a later run has to know of them."""
    spark = edges.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = edges.select(_node(F.col("src_entity"), F.col("src_key")).alias("node"), "dst_entity", "dst_key", "src_entity")
    named = save_table(named, workspace(spark, "edges"))
    hot = named.groupBy("node").count().where(F.col("count") > hot_edges).select("node", F.ceil(F.col("count") / hot_edges).alias("parts"))
    hot = save_table(hot, f"{path}/hot")
    split = not hot.isEmpty()
    if split:
        parts = F.coalesce("parts", F.lit(1).cast("bigint"))
        named = named.join(hot, "node", "left").withColumn("part", F.pmod(F.monotonically_increasing_id(), parts))
        named = named.withColumn("bucket_key", _part("node", "part"))
    else:
        named = named.withColumnRenamed("node", "bucket_key")
    spark.createDataFrame([(buckets, split)], "buckets INT, split BOOLEAN").coalesce(1).write.mode("overwrite").json(f"{path}/settings")
    name = f"headgate_edges_{uuid.uuid4().hex}"
    dealt = named.repartition(buckets, "bucket_key").select("bucket_key", "dst_entity", "dst_key", "src_entity")
    writer = dealt.write.mode("overwrite").partitionBy("src_entity").bucketBy(buckets, "bucket_key")
    writer.option("path", f"{path}/edges").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def traverse(
    edges: DataFrame, roots: DataFrame, max_depth: int | None = None, state: str | None = None, by_group: bool = False, hot_edges: int = HOT_EDGES
) -> DataFrame:
    """Nodes reachable from the roots at their smallest depth.

    `roots` has `entity, key, group_id`. Each node comes once, with the smallest group id of those
    that reach it first; with `by_group` it comes once for every group that reaches it, so that
    each group has its whole subgraph. Without `max_depth` it runs until a level is empty. Edges and
    roots with a null in a key lead nowhere. A node's edges are split from `hot_edges` on.
    """
    spark = edges.sparkSession
    state = state or workspace(spark, "traverse")
    _write_edges(edges.dropna(), state, hot_edges)
    start = roots.select("entity", "key", "group_id", _node(F.col("entity"), F.col("key")).alias("node")).where("node IS NOT NULL")
    with opened(spark, state, -1) as tables:
        tables.write_level(_once(start, by_group), 0)
    return resume_traversal(spark, state, 0, max_depth, by_group)


def _once(reached: DataFrame, by_group: bool) -> DataFrame:
    """Every node once, or once for a group."""
    ids, group = (["node", "group_id"], []) if by_group else (["node"], [F.min("group_id").alias("group_id")])
    return reached.groupBy(*ids).agg(F.any_value("entity").alias("entity"), F.any_value("key").alias("key"), *group)


def next_level(tables: State, depth: int, at: list[str], by_group: bool) -> DataFrame:
    """The nodes that the level reaches and no level has."""
    edges = tables.spark.table(tables.edges).where(F.col("src_entity").isin(at))
    reached = tables.frontier(depth).join(edges, "bucket_key").select(
        _node(F.col("dst_entity"), F.col("dst_key")).alias("node"), F.col("dst_entity").alias("entity"), F.col("dst_key").alias("key"), "group_id"
    )
    reached = _once(reached, by_group)
    known = tables.visited(depth).select(F.col("node").alias("known"), F.col("group_id").alias("known_group"))
    same = F.col("node") == F.col("known")
    if by_group:
        same = same & F.col("group_id").eqNullSafe(F.col("known_group"))
    # Not an anti-join: the optimizer would move that below the deduplication, where a hot node is many rows.
    return reached.join(known, same, "left").where("known IS NULL").drop("known", "known_group")


def resume_traversal(
    spark: SparkSession, state: str, depth: int, max_depth: int | None = None, by_group: bool = False
) -> DataFrame:
    """Go on from level `depth` of a saved state; the result is that of one uninterrupted run."""
    with opened(spark, state, depth) as tables:
        at = tables.entities(depth)
        while at and (max_depth is None or depth < max_depth):
            fresh = next_level(tables, depth, at, by_group)
            depth += 1
            at = tables.write_level(fresh, depth)
    return spark.read.schema(NODE_SCHEMA).parquet(f"{state}/nodes").where(F.col("depth") <= depth)


def traversal_token(spark: SparkSession, state: str, depth: int, as_of: str, by_group: bool = False, **metadata: str) -> str:
    """Token of a traversal that has reached `depth`: the visited nodes and the frontier stay in the state folder that it names."""
    more = {**metadata, "state": state, "by_group": str(by_group).lower()}
    pairs = F.create_map(*[F.lit(x) for pair in more.items() for x in pair])
    position = F.struct(F.lit(depth).alias("current_depth"))
    return spark.range(1).select(encode_token(F.lit("subgraph"), position, F.lit(as_of).cast("timestamp_ntz"), pairs)).first()[0]


def resume_token(spark: SparkSession, token: str, max_depth: int | None = None) -> DataFrame:
    """Go on with the traversal that a token names."""
    p = spark.range(1).select(parse_token(F.lit(token)).alias("p")).first()["p"]
    if p is None or p["type"] != "subgraph" or "state" not in (p["metadata"] or {}):
        raise ValueError("not the token of a traversal with a state folder")
    return resume_traversal(spark, p["metadata"]["state"], p["position"]["current_depth"] or 0, max_depth, p["metadata"].get("by_group") == "true")


def group_report(nodes: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Nodes and deepest level per group; a group that ended before the limit is completed."""
    report = nodes.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("nodes"), F.max("depth").alias("deepest")
    )
    done = F.lit(True) if max_depth is None else F.col("deepest") < max_depth
    return report.withColumn("completed", done)


def manifest_walk(rows: DataFrame, part: str, parent: str, level: str) -> DataFrame:
    """Level and root of every manifest row recomputed from the parent links, in log2(depth) rounds.

    In each round the links that lead 2^k parts up are joined with themselves, and with the parts
    that are known to lie less than 2^k below a root. A part used below several roots has a row for
    each of them, with the shortest way. Rows in a cycle or below a missing parent are reached from
    no root: their level is NULL. The rounds end when no link is left, or, where only links of
    cycles are left, once they are longer than there are parts.
    """
    spark = rows.sparkSession
    key, above = column(part).cast("string"), column(parent).cast("string")
    links = rows.select(key.alias("node"), above.alias("at")).where("node IS NOT NULL").distinct()
    links = save_table(links, workspace(spark, "links"))
    up = links.where("at IS NOT NULL")
    done = links.where("at IS NULL").select("node", F.col("node").alias("root"), F.lit(0).alias("depth"))
    parts, reach = links.select("node").distinct().count(), 1
    while reach <= parts and not up.isEmpty():
        ahead = done.select(F.col("node").alias("at"), "root", (F.col("depth") + reach).alias("depth"))
        more = done.union(up.join(ahead, "at").select("node", "root", "depth"))
        done = save_table(more.groupBy("node", "root").agg(F.min("depth").alias("depth")), workspace(spark, "done"))
        further = up.join(up.select(F.col("node").alias("at"), F.col("at").alias("beyond")), "at")
        up = save_table(further.select("node", F.col("beyond").alias("at")).distinct(), workspace(spark, "up"))
        reach *= 2
    found = done.select(F.col("node").alias("_k"), F.col("depth").alias("walk_level"), "root")
    return (
        rows.select(column(part), column(parent), column(level))
        .join(found, key == F.col("_k"), "left")
        .drop("_k")
        .withColumn("level_ok", F.coalesce(column(level) == F.col("walk_level"), F.lit(False)))
    )
