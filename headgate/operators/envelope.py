"""Uniform change records, and extraction to files with a trailing state row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from headgate.functions.names import column
from headgate.functions.tokens import encode_token, rfc3339
from headgate.functions.values import epoch_micros, tagged_value
from headgate.session import save_table

UPSERT = "UPSERT"


def to_envelope(df: DataFrame, entity: str) -> DataFrame:
    """One change record per row: entity, op and the row as a struct."""
    return df.select(F.lit(entity).alias("entity"), F.lit(UPSERT).alias("op"), F.struct("*").alias("data"))


def to_cells(df: DataFrame, entity: str, key: str) -> DataFrame:
    """Long form: one tagged value per cell, in one pass and without a shuffle."""
    cells = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), tagged_value(F.col(f"`{f.name}`"), f.dataType).alias("cell"))
            for f in df.schema.fields
        ]
    )
    long = df.select(F.col(key).cast("string").alias("key"), F.explode(cells).alias("c"))
    return long.select(
        F.lit(entity).alias("entity"),
        F.lit(UPSERT).alias("op"),
        "key",
        "c.column",
        "c.cell.kind",
        "c.cell.value",
    )


def kind_counts(df: DataFrame) -> DataFrame:
    """Cells per column and kind."""
    key = df.columns[0]
    return to_cells(df, "", key).groupBy("column", "kind").agg(F.count(F.lit(1)).alias("cells"))


def extract(
    df: DataFrame, path: str, entity: str, key: str, as_of: str, ts: str | None = None, group: str = "all"
) -> tuple[DataFrame, DataFrame]:
    """Write all rows, then one state row for what was written.

    With a timestamp the state's token is the last `(ts, key)`, without one it is the number of
    rows. The state is computed from the committed files and at most two columns, so a retried
    task cannot count twice.
    """
    rows = save_table(df, path)
    now = F.lit(as_of).cast("timestamp_ntz")
    if ts is None:
        state = rows.agg(F.count(F.lit(1)).alias("records"), F.max(key).alias("last_key"))
        token = encode_token(F.lit("offset"), F.struct(F.col("records").alias("offset")), now)
        watermark = F.lit(None).cast("bigint")
    else:
        last = F.max(F.struct(F.col(ts).alias("ts"), F.col(key).alias("key")))
        state = rows.agg(F.count(F.lit(1)).alias("records"), last.alias("last"))
        state = state.select("records", F.col("last.ts").alias("last_ts"), F.col("last.key").alias("last_key"))
        position = F.struct(
            rfc3339(F.col("last_ts")).alias("timestamp"), F.col("last_key").cast("string").alias("last_id")
        )
        token = encode_token(F.lit("timestamp"), position, now)
        watermark = epoch_micros(F.col("last_ts"), df.schema[ts].dataType)
    return rows, state.select(
        F.lit(entity).alias("entity"),
        token.alias("token"),
        watermark.alias("watermark"),
        F.lit(group).alias("group_id"),
        "records",
        "last_key",
    )


def observed_extract(df: DataFrame, path: str, size: Column, ts: str) -> DataFrame:
    """Write all rows; one row of `records, bytes, watermark` that the write itself has measured.

    Nothing is read again. Spark takes over what a task has observed once, with its committed
    output, so a task that is run twice does not count twice.
    """
    seen = Observation("extraction")
    measures = [
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes"),
        F.max(column(ts)).alias("watermark"),
    ]
    df.observe(seen, *measures).write.mode("overwrite").parquet(path)
    found = seen.get
    kind = df.schema[ts].dataType.simpleString()
    row = (found["records"], found["bytes"], found["watermark"])
    return df.sparkSession.createDataFrame([row], f"records BIGINT, bytes BIGINT, watermark {kind}")
