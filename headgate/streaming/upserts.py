"""Upserts from a stream as a few sorted-out runs instead of one piece per batch.

Every batch leaves one run: the newest row of every key it holds, in folders by bucket of the key. As
soon as two runs have the same level, they are merged into one of the next level, so that a table of
n batches is at most log2(n) + 1 runs and every row is rewritten at most log2(n) times. Which runs make
up the table is said by a manifest per batch. A manifest counts once its writer has committed it, and
nothing that an earlier manifest names is touched before that: a batch that fails anywhere, in a merge
or between a merge and the manifest, leaves the table as it was, and its repetition starts from there.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headgate.functions.names import column, unused
from headgate.session import Files

BUCKETS = 4
#: Column of the bucket, which is a folder of a run.
BUCKET = "__bucket"
#: Manifests that are kept with the runs they name: a reader may still be using the last but one.
KEPT_MANIFESTS = 2
MANIFEST = "level INT, first BIGINT, last BIGINT, rows BIGINT, schema STRING"


def newest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of every key, by partial aggregation."""
    row = unused(df, "_row")
    rest = [column(c) for c in df.columns if c != key]
    newest = df.groupBy(column(key)).agg(F.max_by(F.struct(*rest), F.struct(*map(column, order))).alias(row))
    return newest.select(column(key), f"{row}.*").select(*map(column, df.columns))


@dataclass(frozen=True)
class Run:
    """The merged rows of the batches from `first` to `last`; two runs of a level make one of the next."""

    level: int
    first: int
    last: int
    rows: int

    def folder(self, path: str) -> str:
        return f"{path}/runs/{self.first}-{self.last}"


def manifests(spark: SparkSession, path: str) -> list[int]:
    """Batches with a committed manifest, in order."""
    files = Files(spark, path)
    numbers = sorted(int(n.removeprefix("batch-")) for n in files.names(f"{path}/manifests"))
    return [n for n in numbers if files.exists(f"{path}/manifests/batch-{n}/_SUCCESS")]


def runs_of(spark: SparkSession, path: str, batch: int) -> tuple[list[Run], StructType]:
    """The runs that a manifest names, oldest first, and the columns of the table."""
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifests/batch-{batch}").collect()
    runs = sorted((Run(r.level, r.first, r.last, r.rows) for r in rows), key=lambda r: r.first)
    return runs, StructType.fromJson(json.loads(rows[0].schema))


def write_manifest(spark: SparkSession, path: str, batch: int, runs: list[Run], schema: StructType) -> None:
    """The swap: the manifest counts from the moment that Spark's writer has committed it."""
    rows = [(r.level, r.first, r.last, r.rows, schema.json()) for r in runs]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}/manifests/batch-{batch}")


def write_run(rows: DataFrame, path: str, run: Run, key: str, buckets: int) -> Run:
    bucketed = rows.withColumn(BUCKET, F.pmod(F.xxhash64(column(key)), F.lit(buckets)).cast("int"))
    folder = run.folder(path)
    bucketed.repartition(buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    # Counted in the footers of what was written. A run without rows has no file to be read.
    rows = rows.sparkSession.read.schema(rows.schema).parquet(folder).count()
    return Run(run.level, run.first, run.last, rows)


def upsert_writer(path: str, key: str, order: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Apply every batch of a stream to the table at `path`: the newest row of a key by `order` is the one that counts.

    A batch costs what it holds and its share of the merges. A batch whose manifest is there was
    applied and is left alone, so one table belongs to one checkpoint. A null key is a key like any
    other; of rows equal in `order` either counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if BUCKET in batch.columns:
            raise ValueError(f"{BUCKET} is the name of the bucket's folders and cannot be a column")
        spark, done = batch.sparkSession, manifests(batch.sparkSession, path)
        if batch_id in done:
            return
        before = [b for b in done if b < batch_id]
        old_runs = runs_of(spark, path, before[-1])[0] if before else []
        runs = [*old_runs, write_run(newest_per_key(batch, key, order), path, Run(0, batch_id, batch_id, 0), key, buckets)]
        while len(runs) > 1 and runs[-2].level <= runs[-1].level:
            old, new = runs[-2:]
            merged = newest_per_key(read_runs(spark, path, [old, new], batch.schema), key, order)
            runs[-2:] = [write_run(merged, path, Run(old.level + 1, old.first, new.last, 0), key, buckets)]
        write_manifest(spark, path, batch_id, runs, batch.schema)
        forget(spark, path, [*before, batch_id], [*old_runs, *runs])

    return write


def read_runs(spark: SparkSession, path: str, runs: list[Run], schema: StructType) -> DataFrame:
    """The rows of some runs, with the columns of the table."""
    parts = [spark.read.schema(schema).parquet(r.folder(path)).drop(BUCKET) for r in runs if r.rows]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], schema))


def read_upserts(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """The current row of every key: at most log2(batches) + 1 runs, each with one file for a bucket."""
    done = manifests(spark, path)
    if not done:
        raise ValueError(f"no batch was applied to {path}")
    return newest_per_key(read_runs(spark, path, *runs_of(spark, path, done[-1])), key, order)


def forget(spark: SparkSession, path: str, done: list[int], named: list[Run]) -> None:
    """Delete all manifests but the last ones of `done`, and the runs, older than the last of `named`, that are not among these."""
    files, folders = Files(spark, path), {r.folder(path) for r in named}
    for old in done[:-KEPT_MANIFESTS]:
        files.remove(f"{path}/manifests/batch-{old}")
    for name in files.names(f"{path}/runs"):
        if f"{path}/runs/{name}" not in folders and int(name.split("-")[1]) <= done[-1]:
            files.remove(f"{path}/runs/{name}")
