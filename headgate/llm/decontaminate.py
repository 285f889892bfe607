"""Benchmark decontamination as a prefix-filtered set join, on DataFrame functions only.

Every benchmark item is cut into windows of consecutive words. A window's elements are its word
shingles, put in one global order, the rarest in the corpus first. A document that contains a
window contains all its shingles, so a prefix of one shingle is enough to find it: the join takes
only the rarest shingle of each window. Where the shingle stands gives the one place where the
window could start (positional bound), which must lie inside the document (length bound); then the
words of that item-sized stretch are compared with the window's, one by one.

The documents are read once for the shingles they share with the benchmark. Each of those rows
carries the words around it, so that neither ordering nor comparing needs the texts again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from headgate.llm.tables import kept, words

WINDOW = 13
SHINGLE = 5
#: Shingles of the benchmark up to which their 64-bit names are broadcast (about 16 bytes each);
#: a larger benchmark is joined by shuffling, with the same result.
BROADCAST_SHINGLES = 2_000_000


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`item_id, words, size`: the windows of every item; a shorter item is one window, an empty one has none."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))))
    return items.select("item_id", "w", start.alias("s")).select(
        "item_id", F.slice("w", F.col("s") + 1, window).alias("words"), F.least(F.size("w"), F.lit(window)).alias("size")
    )


def _shingles(windows: DataFrame, length: int) -> DataFrame:
    """`words, size, k, at, gram` of distinct windows: each shingle by its hash, with its offset."""
    k = F.least(F.col("size"), F.lit(length))
    at = F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k")))
    return (
        windows.select("words", "size").distinct().withColumn("k", k)
        .select("words", "size", "k", at.alias("at"))
        .withColumn("gram", F.xxhash64(F.slice("words", F.col("at") + 1, F.col("k"))))
    )


def shared_shingles(documents: DataFrame, grams: DataFrame, window: int) -> DataFrame:
    """`doc_id, n_words, pos, gram, first, around`: where documents have a shingle of the benchmark.

    `around` are the words from `first` on, wide enough for every window that has the shingle.
    """
    lengths = [r[0] for r in grams.select("k").distinct().collect()]  # at most SHINGLE of them
    names = grams.select("gram").distinct()
    if names.count() <= BROADCAST_SHINGLES:
        names = F.broadcast(names)
    texts = documents.select("doc_id", words(F.col("text")).alias("w"))
    last = F.size("w") - min(lengths, default=1)
    places = texts.where(last >= 0).select("doc_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("pos"))
    if len(lengths) == 1:
        k = F.lit(lengths[0])
    else:
        places = places.withColumn("k", F.explode(F.array(*map(F.lit, lengths))))
        places = places.where(F.col("pos") + F.col("k") <= F.size("w"))
        k = F.col("k")
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    return (
        places.withColumn("gram", F.xxhash64(F.slice("w", F.col("pos") + 1, k)))
        .join(names, "gram")
        .select("doc_id", F.size("w").alias("n_words"), "pos", "gram", first.alias("first"),
                F.slice("w", first + 1, 2 * window - 1).alias("around"))
    )


def occurrences(documents: DataFrame, windows: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, start, size, words`: every place of a document where a window occurs, each once."""
    grams = kept(_shingles(windows, shingle), "op1-grams")
    shared = kept(shared_shingles(documents, grams, window), "op1-shared")
    rarity = shared.groupBy("gram").count()
    # A shingle that no document has stands first of all: its window occurs nowhere.
    ranked = grams.join(rarity, "gram", "left").fillna(0, ["count"])
    prefix = (
        ranked.groupBy("words", "size").agg(F.min(F.struct("count", "gram", "at")).alias("rarest"))
        .where(F.col("rarest.count") > 0)
        .select("words", "size", F.col("rarest.gram").alias("gram"), F.col("rarest.at").alias("at"))
    )
    start = F.col("pos") - F.col("at")
    stretch = F.slice("around", F.col("start") - F.col("first") + 1, F.col("size"))
    return (
        shared.join(prefix, "gram").withColumn("start", start)
        .where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
        .where(stretch == F.col("words"))
        .select("doc_id", "start", "size", "words").distinct()
    )


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: `doc_id, n_words, n_hit, n_items, items_sha256, contaminated`.

    A word is hit if it lies in an occurrence of a window. Null and empty texts have no words and
    are never contaminated. Rows of one `doc_id` (null counts as one id) are one document: repeated
    rows all get the result of that document. An item with null id marks words but is not listed;
    repeated items count once. Other columns of either table are left unread. Empty tables give no
    rows or no hits.
    """
    windows = item_windows(benchmark, window)
    found = kept(occurrences(documents, windows, window, shingle), "op1-found")
    # Hit words: lengths of the stretches that reach beyond everything that began earlier.
    in_order = Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("start") + F.col("size")
    begun = F.greatest("start", F.coalesce(F.max("stop").over(in_order), F.lit(0)))
    hits = (
        found.groupBy("doc_id", "start").agg(F.max(stop).alias("stop"))
        .withColumn("new", F.greatest(F.col("stop") - begun, F.lit(0)))
        .groupBy("doc_id").agg(F.sum("new").alias("n_hit"))
    )
    listed = (
        found.select("doc_id", "words").distinct()
        .join(windows.select("words", "item_id").where("item_id IS NOT NULL").distinct(), "words")
        .groupBy("doc_id").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )
    counted = documents.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    hits, listed = hits.withColumnRenamed("doc_id", "h"), listed.withColumnRenamed("doc_id", "l")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        counted.join(hits, F.col("doc_id").eqNullSafe(F.col("h")), "left")
        .join(listed, F.col("doc_id").eqNullSafe(F.col("l")), "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    bad = contamination(documents, benchmark, **options).where("contaminated").select(F.col("doc_id").alias("bad_id")).distinct()
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")), "left_anti")
