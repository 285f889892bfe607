"""Importance resampling towards a target distribution: array-scored weights, then a distributed quickselect.

Features are hashed into buckets, and the log ratio of the target's and the corpus's bucket counts is
one small array: a document's weight is a sum of its elements, computed where the document is read.
Weighted sampling without replacement is drawing the highest of weight plus Gumbel noise, so what
remains is to find the key at one rank among all: random keys of the range still open are pivots,
one scan counts the rows that lie before each pivot and on it, and the range between two pivots that
holds the rank goes into the next round. Nothing is sorted but the rows drawn, and those by ranges.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headgate.llm.tables import dropped, kept, words

BUCKETS = 10_000
NGRAM = 1
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
#: Random keys that split the open range in each round of the selection.
PIVOTS = 64
#: Rows of one range when the drawn rows are ranked.
RANGE_ROWS = 500_000
#: The order in which rows are drawn: score descending, the rest ascending, a missing id last.
ORDER = ("down", "nameless", "doc_id", "n_features", "row")
HIGHEST = 2.0**32


def features(text: Column, n: int = NGRAM) -> Column:
    """All runs of one to `n` consecutive words, joined by a space, repeats included."""
    ws = words(text)
    runs = [ws]
    for size in range(2, n + 1):
        longer = F.zip_with(runs[-1], F.slice(ws, size, F.size(ws)), lambda run, word: F.concat(run, F.lit(" "), word))
        runs.append(F.filter(longer, lambda run: run.isNotNull()))
    return F.concat(*runs) if n > 1 else ws


def buckets(text: Column, n: int, size: int) -> Column:
    return F.transform(features(text, n), lambda f: F.pmod(F.crc32(f.cast("binary")), F.lit(size)).cast("int"))


def bucket_counts(table: DataFrame, size: int) -> list[int]:
    """How often each bucket occurs in the arrays `b` of a table; `size` numbers reach the driver."""
    counts = {r["k"]: r["count"] for r in table.select(F.explode("b").alias("k")).groupBy("k").count().collect()}
    return [counts.get(k, 0) for k in range(size)]


def gains(source: list[int], target: list[int]) -> Column:
    """The gain of each bucket, floor(1000 ln((t+1)(S+size) / ((s+1)(T+size)))), as one constant array."""
    size, s, t = len(source), sum(source), sum(target)
    gain = [math.floor(1000 * math.log((b + 1) * (s + size) / ((a + 1) * (t + size)))) for a, b in zip(source, target, strict=True)]
    return F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by the document's id; a missing id reads as empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / HIGHEST)))


def _before(key: dict, at_or_before: bool = False) -> Column:
    """Whether a row's key lies before `key` in the order of drawing; `nameless` tells a missing id from 0."""
    mine, other = ("struct(" + ", ".join(cells) + ")" for cells in ([f"coalesce({n}, 0L)" for n in ORDER], [f"{key[n] or 0}L" for n in ORDER]))
    return F.expr(f"{mine} {'<=' if at_or_before else '<'} {other}")


def _key(row) -> tuple:
    return tuple((row[name] is None, row[name] or 0) for name in ORDER)


def select_key(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> dict | None:
    """The `k`-th key (from 1) of `keys` in the order of `ORDER`; None if there is no such row.

    Each round reads the open range twice: for the rows with the smallest hash of row and round, its
    random pivots, and for the exact counts of the rows before and on every pivot.
    """
    low, high, below = None, None, 0
    for turn in itertools.count():
        span = [~_before(low, at_or_before=True)] if low else []
        span += [_before(high)] if high else []
        still = keys.where(functools.reduce(operator.and_, span, F.lit(True)))
        random = F.xxhash64("row", F.lit(seed), F.lit(turn))
        chosen = sorted((r.asDict() for r in still.orderBy(random, "row").limit(pivots).collect()), key=_key)
        if k < 1 or not chosen:
            return None
        cells = [F.struct(F.count_if(_before(p)).alias("less"), F.count_if(_before(p, at_or_before=True)).alias("upto")) for p in chosen]
        counts = still.agg(F.array(*cells).alias("c")).first()["c"]
        base = below
        for pivot, count in zip(chosen, counts, strict=True):
            if base + count["less"] < k <= base + count["upto"]:
                return pivot
            if k <= base + count["less"]:
                high = pivot
                break
            low, below = pivot, base + count["upto"]


def ranked(winners: DataFrame, k: int) -> DataFrame:
    """`row, rank` of the rows drawn: sorted into ranges, numbered in each after the counts of those before."""
    parts = max(1, -(-k // RANGE_ROWS))
    placed = winners.repartitionByRange(parts, *ORDER).withColumn("part", F.spark_partition_id())
    placed = kept(placed.select(*ORDER, "part"), "op13-winners")
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part], total = total, total + sizes[part]
    offset = F.split(F.lit(",".join(str(starts.get(p, 0)) for p in range(max(sizes, default=0) + 1))), ",").cast("array<bigint>")
    within = Window.partitionBy("part").orderBy(*ORDER)
    return placed.select("row", (F.get(offset, F.col("part")) + F.row_number().over(within)).cast("long").alias("rank"))


def resample(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, n: int = NGRAM, size: int = BUCKETS, seed: int = SEED, pivots: int = PIVOTS
) -> DataFrame:
    """`doc_id, n_features, weight, score, rank` for every row of `documents` (`doc_id`, `text`), drawn towards `target` (`text`).

    `rank` is null for what is not drawn: all but `percent` in a hundred of the documents with at
    least `least_words` words. Null, empty and wordless texts have no features and weight 0; a missing
    id reads as empty text in the noise and stands after all others. Repeated rows are documents of
    their own: equal in score and id, the one with fewer features goes first, then either. Empty
    tables give no rows; an empty target makes rare words gain. Other columns are left unread.
    """
    n_words = F.size("b") if n == 1 else F.size(words(F.col("text")))
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), buckets(F.col("text"), n, size).alias("b"), n_words.cast("long").alias("n_words"))
    hashed = kept(read.withColumn("row", F.monotonically_increasing_id()), "op13-buckets")
    gain = gains(bucket_counts(hashed, size), bucket_counts(target.select(buckets(F.col("text"), n, size).alias("b")), size))
    total = F.aggregate("b", F.lit(0).cast("long"), lambda acc, k: acc + F.get(gain, k))
    scored = hashed.select("row", "doc_id", "n_words", F.size("b").cast("long").alias("n_features"), total.alias("total"))
    scored = scored.withColumn("weight", F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0).cast("long")))
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).drop("total")
    scored = kept(scored, "op13-scores")
    dropped(hashed)
    keys = scored.where(F.col("n_words") >= least_words).select((-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("long").alias("nameless"), "doc_id", "n_features", "row")
    k = keys.count() * percent // 100
    last = select_key(keys, k, pivots, seed)
    winners = keys.where(_before(last, at_or_before=True)) if last else keys.limit(0)
    every = scored.select("row", "doc_id", "n_features", "weight", "score").join(ranked(winners, k), "row", "left")
    return every.select("doc_id", "n_features", "weight", "score", "rank")
