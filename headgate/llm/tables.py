"""Tables, texts and intermediate results as the corpus operators share them."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headgate.session import workspace

#: Fixed value: everything that separates words once A-Z are lower-case.
WORD_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: lineage ends there, a lost executor costs a re-read."""
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table made by `kept` once everything derived from it has been written."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        removed(df.sparkSession, folder)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; plain ASCII texts take the faster function."""
    plain = F.length(text) == F.octet_length(text)
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(slow)


def words(text: Column) -> Column:
    """Lower-case words of digits, letters and everything beyond ASCII; none for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAPS)
    return F.array_remove(parts, "")
