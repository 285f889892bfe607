"""File listings: metadata of the files below a folder, contents unread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.functions.values import base_name, extension, has_extension

# Extensions of the two listed kinds of files.
MODEL_EXTENSIONS = [".step", ".stp"]
DOCUMENT_EXTENSIONS = [".pdf"]


def list_files(spark: SparkSession, folder: str, extensions: list[str] | None = None) -> DataFrame:
    """Path, name, size, modification time and extension of all files below `folder`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    rows = files.select(
        "path",
        base_name(F.col("path")).alias("name"),
        F.col("length").alias("size"),
        F.unix_micros("modificationTime").alias("modified_micros"),
        extension(F.col("path")).alias("extension"),
    )
    return rows.where(has_extension(F.col("extension"), extensions)) if extensions else rows
