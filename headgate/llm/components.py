"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headgate.llm.tables import dropped, kept


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.union(links.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    inner = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    """Number and order-free checksum of the links, to see whether a round changed anything."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    count, checksum = links.agg(F.count("*"), total).first()
    return count, int(checksum or 0)


def components(links: DataFrame) -> DataFrame:
    """`node, root` for every node that a link `a, b` touches: root is the smallest node reachable.

    Links may repeat, run either way or join a node to itself. Each round is a written table; a
    hot node's neighbours meet its smallest one in a join of a unique key, which Spark may split.
    Needs about log(nodes) rounds. No links give no rows.
    """
    links = links.toDF("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    now = kept(links.where("a <> b").distinct(), "links")
    state = _state(now)
    while state[0]:
        new = kept(_small_star(_large_star(now)), "links")
        dropped(now)
        now, before, state = new, state, _state(new)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
