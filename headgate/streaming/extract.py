"""Continuous extraction, batch state and user callbacks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headgate.functions.names import column, unused
from headgate.plans.search import literal_longs
from headgate.session import save_table, workspace


def stream_table(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table, a file or a folder of files, as a stream."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Stream sources take folders or patterns; this pattern matches exactly `path`, file or folder.
    path = re.sub(r"([*?{}\[\]\\])", r"\\\1", path.rstrip("/"))
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def extract_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to parquet files, exactly once; the position is durable."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def for_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every batch to user code; an error in it stops the query."""
    return (
        stream.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _in_parts(batch: DataFrame, records: int) -> tuple[DataFrame, str, int]:
    """The rows of a batch, written once, with the number of their part as a last column, its name, and how many parts there are.

    All parts but the last have exactly `records` rows. The rows stay where they are written, so that
    reading them again gives the same parts. The driver learns the rows of every partition, not the rows.
    """
    spark, part = batch.sparkSession, unused(batch, "_part")
    held = save_table(batch.withColumn(part, F.monotonically_increasing_id()), workspace(spark, "records"))
    task = F.shiftright(part, 33).cast("int")
    sizes = {r["t"]: r["n"] for r in held.groupBy(task.alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = list(accumulate((sizes.get(t, 0) for t in range(max(sizes, default=0) + 1)), initial=0))
    at = F.get(literal_longs(starts), task) + F.col(part).bitwiseAND((1 << 33) - 1)
    return held.withColumn(part, F.floor(at / records)), part, -(-starts[-1] // records)


def for_all_records(stream: DataFrame, fn: Callable[[DataFrame, int, str], None], records: int, checkpoint: str) -> StreamingQuery:
    """Hand everything available to user code in parts of at most `records` rows, as `fn(rows, batch_id, part)`, once for a batch.

    `part` is the column with the number of a row's part. What `fn` does by part (an aggregation,
    `applyInPandas`) is done on the executors, by as many tasks as there are: a batch costs its rows,
    however many parts they make.
    """
    if records < 1:
        raise ValueError("a batch needs at least one record")

    def parts(batch: DataFrame, batch_id: int) -> None:
        rows, part, _ = _in_parts(batch, records)
        fn(rows, batch_id, part)

    return for_each_batch(stream, parts, checkpoint)


def for_each_records(stream: DataFrame, fn: Callable[[DataFrame, int, int], None], records: int, checkpoint: str) -> StreamingQuery:
    """Hand everything available to user code in batches of at most `records` rows, as `fn(rows, batch_id, part)`.

    All parts of a batch but the last have exactly so many rows. A batch is written once, by part, and
    each part read back, so that a repeated batch has the same parts, and a part never holds more
    than it should. Every part is a call on the driver with jobs of its own, one after another: where
    parts are many, `for_all_records` does them together.
    """
    if records < 1:
        raise ValueError("a batch needs at least one record")

    def parts(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, part, count = _in_parts(batch, records)
        path = workspace(spark, "parts")
        rows.write.partitionBy(part).parquet(path)
        for number in range(count):
            fn(spark.read.schema(batch.schema).parquet(f"{path}/{part}={number}"), batch_id, number)

    return for_each_batch(stream, parts, checkpoint)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, records: int | None = None) -> DataFrame:
    """Hand batches of rows to user code; an error in it fails the read.

    A batch is what Arrow brings, or with `records` exactly so many rows, fewer only at the end of
    a partition.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            if records is None:
                yield fn(batch)
                continue
            waiting.append(batch)
            if sum(map(len, waiting)) >= records:
                rows = pd.concat(waiting, ignore_index=True)
                full = len(rows) // records * records
                for at in range(0, full, records):
                    yield fn(rows.iloc[at : at + records].reset_index(drop=True))
                waiting = [rows.iloc[full:]]
        if sum(map(len, waiting)):
            yield fn(pd.concat(waiting, ignore_index=True))

    return df.mapInPandas(run, schema)


def state_writer(path: str, ts: str) -> Callable[..., None]:
    """Per batch one state row: records and watermark; one for every part where `part` names a column of parts.

    A repeated batch replaces its own rows.
    """

    def write(batch: DataFrame, batch_id: int, part: str | None = None) -> None:
        by = [column(part).alias("part")] if part else []
        state = batch.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), F.max(ts).alias("watermark"))
        state.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write
