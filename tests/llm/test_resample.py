"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

from pyspark.sql import functions as F

from headgate.llm.resample import ORDER, features, resample, select_key

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(documents, target, percent, least, n, size, seed):
    def runs(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % size for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    docs = [(i, runs(x), len(plain_words(x))) for i, x in documents]
    s, t = Counter(b for _, bs, _ in docs for b in bs), Counter(b for x in target for b in runs(x))
    whole_s, whole_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (whole_s + size) / ((s[b] + 1) * (whole_t + size)))) for b in range(size)]
    rows = []
    for i, bs, words in docs:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = rank + 1
    return Counter(tuple(r[:5]) for r in rows)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    target = ["one two", None, "", "the straße W5 w6", "one two"]
    items = spark.createDataFrame([(i, x, 1) for i, x in enumerate(target)], "item_id long, text string, row int")
    for percent, least, n, size in ((60, 1, 1, 10_000), (60, 0, 3, 7), (0, 1, 1, 10)):
        got = resample(odd_documents, items, percent, least, n, size, 7, pivots=4).collect()
        assert Counter(map(tuple, got)) == plain(rows, target, percent, least, n, size, 7)
    assert Counter(map(tuple, resample(odd_documents, items.limit(0), 50, 1).collect())) == plain(rows, [], 50, 1, 1, 10_000, 2024)
    assert resample(no_documents, items).count() == 0


def test_features_are_runs_of_words(spark):
    row = spark.sql("SELECT 'A b  C' AS text, 'x' AS one, '' AS none").select(features(F.col("text"), 3), features(F.col("one"), 3), features(F.col("none"), 3)).first()
    assert list(row) == [["a", "b", "c", "a b", "b c", "a b c"], ["x"], []]


def test_key_at_every_rank(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(4), int(d is None), d, rng.randrange(2), r) for r in range(90) for d in [rng.choice([None, 1, 2, 3])]]
    keys = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ORDER)).cache()
    order = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0, r[3], r[4]))
    for k in (1, 45, 90):
        assert tuple(select_key(keys, k, pivots=8, seed=k).values()) == order[k - 1]
    assert select_key(keys, 0) is None and select_key(keys, 91) is None
