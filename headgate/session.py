"""Where intermediate tables go, and how a session for tests and benches is made."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "headgate", **conf: str) -> SparkSession:
    """Single-machine session for tests and benches; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A folder of our own is used only for a local master without the setting.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if context.applicationId not in _fallback:
        _fallback[context.applicationId] = tempfile.mkdtemp(prefix="headgate-")
    return _fallback[context.applicationId]


def workspace(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared folder."""
    return f"{shared_dir(spark)}/headgate/{name}-{uuid.uuid4().hex}"


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Write `df` to `path` and read it back.

    The lineage ends at durable files, so a lost executor costs a re-read rather than a
    re-computation, and the known file sizes let the planner choose the joins that follow.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while; a stream that is started meanwhile keeps them."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Files:
    """The few things that are needed of the file system a folder is on."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def exists(self, file: str) -> bool:
        return self._fs.exists(self._path(file))

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)
