"""Rows that are delivered more than once, written once.

What was delivered is state of the stream: Spark's state store holds the keys, in RocksDB on the
executors, with change logs in the checkpoint folder. A batch looks up and adds only its own keys,
however many batches were before. A key is never forgotten, so no row is left out for being late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from headgate.functions.names import column
from headgate.session import settings

#: Spark's settings for keyed state that is on disk and saved as changes.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: State partitions that also a small cluster has: keys are on disk, so a partition may hold millions.
LEAST_PARTITIONS = 12


def first_deliveries(stream: DataFrame, key: str) -> DataFrame:
    """The rows of a stream whose key no row before had; one of those that come together with it.

    A null key tells nothing: rows without a key all stay, on a path of their own past the state.
    """
    keyed, others = stream.where(column(key).isNotNull()), stream.where(column(key).isNull())
    return keyed.dropDuplicates([key]).union(others)


def state_partitions(spark: SparkSession) -> int:
    """As many state partitions as tasks run at a time, at least `LEAST_PARTITIONS`; no more than shuffles have.

    Every batch opens and commits every state partition, so their number must not grow with the table.
    """
    return min(int(spark.conf.get(SHUFFLE_PARTITIONS)), max(LEAST_PARTITIONS, spark.sparkContext.defaultParallelism))


def deliver_once(stream: DataFrame, key: str, path: str, checkpoint: str, partitions: int | None = None) -> StreamingQuery:
    """Write the first delivery of every key to parquet files at `path`, exactly once.

    The number of state partitions is `partitions`, or that of `state_partitions`, when the checkpoint
    is new; a later run goes on with the keys and the partitions that the checkpoint holds.
    """
    spark = stream.sparkSession
    with settings(spark, STATE_SETTINGS | {SHUFFLE_PARTITIONS: str(partitions or state_partitions(spark))}):
        return (
            first_deliveries(stream, key)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
