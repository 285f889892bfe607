"""Approximate nearest neighbours in a permutation index.

A vector is represented by the order of its nearest pivots. The index is dealt to shards; a shard
posts each of its vectors in the inverted files of these pivots, with the position. A query reads
the files of its own nearest pivots and ranks what it finds by footrule distance: with positions a
and b of a pivot (m where it is not among the m nearest) the sum of |a - b| over all pivots is
m(m+1) - 2 x the sum of m - max(a, b) over the common ones, so one pass over the postings gives it.
The best ranked are compared by their true inner product.

How many have to be compared depends on the data alone: a bounded sample, searched by brute force,
tells the part of a shard that holds `AIM` of the true neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from headgate.llm.tables import kept

NEAREST = 20
QUERY_STEP = 20
PIVOTS = 1024
POSTED = 64
#: Vectors sampled (first by hash) for pivots and calibration, and those of them that act as queries.
SAMPLE = 8192
TRIALS = 128
AIM = 0.96
#: Vectors of a shard and queries of a block: what one task holds.
SHARD = 16_384
QUERIES = 4096


def _directions(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def permutations(x: np.ndarray, pivots: np.ndarray, posted: int = POSTED) -> np.ndarray:
    """For each vector its nearest pivots, nearest first; ties go to the earlier pivot."""
    near = _directions(x) @ pivots.T
    m = min(posted, len(pivots))
    return np.argsort(-near, axis=1, kind="stable")[:, :m].astype(np.int32)


class InvertedFiles:
    """Postings of a shard: for each pivot the vectors that have it among their nearest, and m - position."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.size, self.m = orders.shape
        flat = orders.ravel()
        by = np.argsort(flat, kind="stable")
        self.start = np.searchsorted(flat[by], np.arange(pivots + 1))
        self.vector = by // self.m
        self.weight = (self.m - by % self.m).astype(np.float64)

    def common(self, order: np.ndarray) -> np.ndarray:
        """Sum of m - max(a, b) per vector: the larger, the smaller the footrule distance."""
        at = [slice(self.start[p], self.start[p + 1]) for p in order]
        ids = np.concatenate([self.vector[s] for s in at])
        gains = np.concatenate([np.minimum(self.weight[s], self.m - a) for a, s in enumerate(at)])
        return np.bincount(ids, weights=gains, minlength=self.size)


def _compared(common: np.ndarray, part: float, least: int) -> np.ndarray:
    """The vectors of the best ranks, ties of the last rank included."""
    wanted = max(int(np.ceil(part * len(common))), least)
    if wanted >= len(common):
        return np.arange(len(common))
    return np.nonzero(common >= np.partition(common, len(common) - wanted)[len(common) - wanted])[0]


def _inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, summed alike for every row, so that equal vectors have equal ones."""
    return (x * q).sum(axis=1)


def calibrate(sample: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST, aim: float = AIM) -> float:
    """The part of a shard, by rank, in which `aim` of the sample's true neighbours lie."""
    if len(sample) <= nearest + 1:
        return 1.0
    orders = permutations(sample, pivots)
    files = InvertedFiles(orders, len(pivots))
    places = []
    for k in np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int):
        true = _inner(sample, sample[k])
        true[k] = -np.inf
        best = np.argpartition(-true, nearest)[:nearest]
        common = files.common(orders[k])
        common[k] = -1
        places.append([(common >= common[b]).sum() for b in best])
    return float(min(1.0, np.quantile(np.array(places), aim) / (len(sample) - 1)))


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id, embedding` that take part, each id once: of repeated ids the smallest vector."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    return vectors.select("vec_id", x.alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL").where(sound).groupBy("vec_id").agg(F.min("x").alias("x"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which changes no inner product."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _search(shared, width: int, part: float, nearest: int):
    def tasks(shard: pa.Table, queries: pa.Table) -> pa.Table:
        pivots = shared.value
        ids, x = shard.column("vec_id").to_numpy(), _matrix(shard.column("x"), width)
        files = InvertedFiles(permutations(x, pivots), len(pivots))
        names, q = queries.column("query_id").to_numpy(), _matrix(queries.column("q"), width)
        found = []
        for name, vector, order in zip(names.tolist(), q, permutations(q, pivots), strict=True):
            some = _compared(files.common(order), part, 4 * nearest)
            some = some[ids[some] != name]
            score = _inner(x[some], vector)
            if len(some) > nearest:
                close = score >= np.partition(score, len(score) - nearest)[len(score) - nearest]
                some, score = some[close], score[close]
            best = np.lexsort((ids[some], -score))[:nearest]
            found.append((np.full(len(best), name), ids[some][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table({"query_id": columns[0].astype(np.int64), "vec_id": columns[1].astype(np.int64), "score": columns[2]})

    return tasks


def nearest_neighbours(vectors: DataFrame, step: int = QUERY_STEP, nearest: int = NEAREST, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """`query_id, rank, vec_id, score`: the nearest of every vector whose id is divisible by `step`.

    Vectors that are null, empty, zero or hold null or non-finite numbers take no part, nor do rows
    without id. A shorter vector counts as ending in zeros. Ties go to the smaller id. Other columns
    are left unread; an empty table or one without queries gives no rows.
    """
    spark = vectors.sparkSession
    table = kept(usable(vectors), "op8-vectors")
    total, width = table.agg(F.count("*"), F.max(F.size("x"))).first()
    asked = table.where(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), F.col("x").alias("q"))
    number = asked.count()
    shards, blocks = max(1, -(-(total or 0) // shard)), max(1, -(-number // queries))
    rows = table.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()  # at most SAMPLE vectors
    sample = np.zeros((len(rows), width or 0))
    for k, row in enumerate(rows):
        sample[k, : len(row["x"])] = row["x"]
    pivots = _directions(sample[:PIVOTS]) if len(rows) else sample
    part = calibrate(sample, pivots, nearest) if len(rows) else 1.0
    # Every block of queries meets every shard: neither side is larger than a task holds.
    left = table.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("long").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "x")
    right = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), "query_id", "q")
    keys = ["shard", "block"]
    tasks = _search(spark.sparkContext.broadcast(pivots), width or 0, part, nearest)
    either = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_both(tasks), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return either.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def _both(tasks):
    """Nothing is found where a shard has no queries or a block no vectors."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            none = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
            return pa.table(none)
        return tasks(left, right)

    return run
