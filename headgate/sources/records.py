"""Quoted records that may span lines, read by as many tasks as the files have blocks.

Whether a line begins a record depends on the quotes before it. A line turns the state it is met in
(outside quotes or inside) into another one, and so does a block of lines; what the lines of a block
do is found in both states at once. The few rows that say so, one per block, are combined in the
order of the blocks, which fixes the state at the start of each; from there every line knows the
number of its record. Only records of several lines are then put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# States within a line: at the start of a cell, further on in it, in quotes, and past a quote that
# either ends the quotes or is the first of two.
START, WITHIN, QUOTED, CLOSED = range(4)


def _at_quote(state: Column, text: Column, sep: str) -> Column:
    """The state after `text`, which holds no quote, and the quote that follows it."""
    new_cell = text.endswith(sep) | ((state == START) & (text == ""))
    return (
        F.when(state == QUOTED, CLOSED)
        .when((state == CLOSED) & (text == ""), QUOTED)
        .when(new_cell, QUOTED)
        .otherwise(WITHIN)
    )


def _stays_open(line: Column, start: int, sep: str) -> Column:
    """1 if a line met in state `start` ends inside quotes, else 0."""
    parts = F.split(line, '"', -1)
    before = F.slice(parts, F.lit(1), F.size(parts) - 1)
    ended = F.aggregate(before, F.lit(start), lambda state, text: _at_quote(state, text, sep).cast("int"))
    same = F.lit(1 if start == QUOTED else 0)
    return F.when(line.contains('"'), (ended == QUOTED).cast("int")).otherwise(same)


def _met(outside: Column, inside: Column, order, names: list[str]):
    """Two steps that add the states before and behind each row of a window, met in state 0 and in 1.

    A row turns 0 into `outside` and 1 into `inside`. Rows that end alike in both states fix the
    state; of the rows since the last such one only the number that swap the states matters.
    """
    swap = (outside > inside).cast("int")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(outside == inside, (outside + F.col("_swaps")) % 2)

    def add(df: DataFrame) -> DataFrame:
        df = df.withColumn("_swaps", F.sum(swap).over(upto))
        df = df.withColumns({"_upto": F.last(fixed, True).over(upto), "_earlier": F.last(fixed, True).over(earlier)})
        before = {f"before{s}": (F.coalesce("_earlier", F.lit(s)) + F.col("_swaps") - swap) % 2 for s in (0, 1)}
        after = {f"after{s}": (F.coalesce("_upto", F.lit(s)) + F.col("_swaps")) % 2 for s in (0, 1)}
        return df.select(*names, *[c.alias(n) for n, c in (before | after).items()])

    return add


def quoted_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """`file, block, at, first, value`: the records of the text files at `path`.

    `block, at` order the records of a file, and `first` tells its first one. A quote opens at the
    start of a cell only; inside, a doubled quote is one character. Lines end in LF, CR LF or CR;
    inside quotes each of them is read as LF. Empty lines outside quotes are no records. A quote that
    is never closed makes the rest of the file one record. Where no line leaves a quote open, which
    one pass finds out, lines stay where they are read and nothing is shuffled.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"),
        # Lines of a block are read by one task, in order: the numbers rise, which is all that counts.
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    ends = [_stays_open(F.col("value"), start, sep) for start in (START, QUOTED)]
    # If every line that is met outside quotes ends outside, all are met there.
    if lines.where(F.col("value").contains('"') & (ends[0] == 1)).isEmpty():
        return _single_lines(lines.where("value != ''"))
    return _joined_lines(lines.select("*", ends[0].alias("outside"), ends[1].alias("inside")))


def _single_lines(lines: DataFrame) -> DataFrame:
    firsts = lines.groupBy("file").agg(F.min(F.struct("block", "at")).alias("start"))
    place = F.struct("block", "at")
    return lines.join(firsts, "file").select("file", "block", "at", (place == F.col("start")).alias("first"), "value")


def _joined_lines(lines: DataFrame) -> DataFrame:
    within = Window.partitionBy("file", "block").orderBy("at")
    names = ["file", "block", "at", "value"]
    lines = _met(F.col("outside"), F.col("inside"), within, names)(lines)
    # An empty line inside quotes belongs to its record; one outside opens none.
    lines = lines.withColumns({f"opens{s}": ((F.col(f"before{s}") == 0) & (F.col("value") != "")).cast("int") for s in (0, 1)})
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumns({f"number{s}": F.sum(f"opens{s}").over(upto) for s in (0, 1)})

    blocks = lines.groupBy("file", "block").agg(
        *[F.max_by(f"after{s}", "at").alias(n) for s, n in ((0, "outside"), (1, "inside"))],
        *[F.sum(f"opens{s}").alias(f"opened{s}") for s in (0, 1)],
    )
    inside = Window.partitionBy("file").orderBy("block")
    blocks = _met(F.col("outside"), F.col("inside"), inside, ["file", "block", "opened0", "opened1"])(blocks)
    opened = F.when(F.col("before0") == 0, F.col("opened0")).otherwise(F.col("opened1"))
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.col("before0").alias("state"), F.coalesce(F.sum(opened).over(earlier), F.lit(0)).alias("base"))

    def met(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    known = lines.join(blocks, ["file", "block"])
    known = known.select(*names, (F.col("base") + met("number")).alias("number"), met("opens").alias("opens"), met("after").alias("after"))
    first = (F.col("number") == 1).alias("first")
    alone = known.where("opens = 1 AND after = 0").select("file", "block", "at", first, "value")
    # The rest are lines of longer records, but for empty lines between records.
    several = known.where("after = 1 OR (opens = 0 AND value != '')").groupBy("file", "number")
    several = several.agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value")
    start = F.col("lines")[0]
    return alone.unionAll(several.select("file", start["block"].alias("block"), start["at"].alias("at"), first, text))
