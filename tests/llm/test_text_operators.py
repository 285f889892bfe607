"""Decontamination, near-duplicates, repeats and personal data against plain code."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from headgate.llm.decontaminate import contamination, decontaminate
from headgate.llm.personal import find_personal, mask_personal
from headgate.llm.repeats import without_repeats
from headgate.llm.components import components
from headgate.llm.simhash import deduplicate, fingerprint, levels_for, near_duplicates, near_links
from headgate.llm.tables import read

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return WORDS.findall((text or "").translate(LOWER))


def contaminated(documents, items):
    windows = {}
    for item, text in items:
        w = cut(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    found = []
    for doc, text in documents:
        w, hit, ids = cut(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    ids |= {str(x) for x in windows[k] if x is not None}
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        found.append((doc, len(w), len(hit), len(ids), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return found


def test_contamination_of_odd_rows(spark, odd_documents):
    items = [(1, "ONE two, three four five six seven eight nine ten eleven twelve thirteen fourteen!"), (10, "漢字"), (2, "漢字"), (2, "漢字"),
             (3, None), (4, "..."), (None, "tie tie tie"), (5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination(odd_documents, benchmark).collect()
    documents = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert Counter(map(tuple, rows)) == Counter(contaminated(documents, items))
    left = decontaminate(odd_documents, benchmark)
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 4, 5, 7, 7, 9]


def test_no_rows(spark, no_documents, odd_documents):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert contamination(no_documents, benchmark).count() == 0
    assert contamination(odd_documents, benchmark).where("n_hit > 0").count() == 0
    assert near_duplicates(no_documents).count() == 0 and deduplicate(no_documents).count() == 0
    assert without_repeats(no_documents).count() == 0
    assert find_personal(no_documents).count() == 0 and mask_personal(no_documents).count() == 0


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(odd_documents):
    for row in odd_documents.where("doc_id <> 9").collect():
        assert fingerprint((row.text or "").encode()) == plain_fingerprint(row.text)


def near_texts():
    """Groups of long texts that differ in a word or two, and texts of their own."""
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(600)]
        for _ in range(12):
            other = list(base)
            for _ in range(rng.randrange(3)):
                other[rng.randrange(600)] = f"x{rng.randrange(99)}"
            texts.append(" ".join(other))
    return texts + [" ".join(f"v{rng.randrange(5000)}" for _ in range(rng.randrange(2, 40))) for _ in range(60)]


@pytest.mark.parametrize("block", [20_000, 7])
def test_components_are_those_of_all_pairs(spark, block):
    texts = [None, "", "  "] + near_texts()
    ids = list(range(100, 100 + len(texts)))
    random.Random(1).shuffle(ids)
    prints = [plain_fingerprint(t) for t in texts]
    root = dict(zip(ids, ids, strict=True))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((top(ids[i]), top(ids[j])))
                root[b], links = a, links + (prints[i] != prints[j])
    documents = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(documents, block=block).collect()}
    assert links > 100
    assert got == {i: (format(p, "016x"), top(i)) for i, p in zip(ids, prints, strict=True)}


def test_one_of_each_group_stays(odd_documents):
    left = deduplicate(odd_documents)
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 3, 6, 7, 8, 9]


def without(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield len(t), sum(gone), runs, hashlib.sha256(left).hexdigest()


def test_repeats_are_those_of_all_windows(spark, odd_documents):
    rng = random.Random(5)
    pool = ["".join(rng.choice("abc é\n") for _ in range(rng.randrange(150, 500))) for _ in range(12)]
    texts = ["".join(rng.choice([rng.choice(pool)[rng.randrange(60) :], "".join(rng.choice("xyz ") for _ in range(rng.randrange(90)))]) for _ in range(rng.randrange(6))) for _ in range(150)]
    texts += ["a" * 199, "b" * 200, "c" * 201, "ab" * 300, "ab" * 299 + "c", "", pool[0], pool[0]]
    documents = spark.createDataFrame([(i % 140, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(documents).collect())
    assert got == Counter(without([t.encode() for t in texts], 200))
    odd = odd_documents.where("doc_id IS NULL OR doc_id < 8")
    got = Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(odd).collect())
    assert got == Counter(without([(r.text or "").encode() for r in odd.collect()], 200))


@pytest.mark.parametrize("least", [2, 10**9])
def test_repeats_whichever_cores_are_frequent(spark, monkeypatch, least):
    """Sentences on every page, short of a window and beyond one, with all cores spread and with none."""
    from headgate.llm import repeats

    monkeypatch.setattr(repeats, "LEAST", least)
    monkeypatch.setattr(repeats, "FREQUENT", 0)
    rng = random.Random(8)
    notices = ["".join(rng.choice("abcdefgh ") for _ in range(size)) for size in (100, 208, 260)]
    texts = []
    for _ in range(120):
        own = ["".join(rng.choice("xyzw ") for _ in range(rng.randrange(120, 300))) for _ in range(3)]
        texts.append("".join(own[k] + (notices[k] if rng.random() < 0.9 else "") for k in range(3)))
    texts += texts[:3]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(documents).collect())
    assert got == Counter(without([t.encode() for t in texts], 200))


def test_a_frequent_core_is_dealt_to_many_tasks(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from headgate.llm import repeats

    rng = random.Random(9)
    notice = "we use cookies to keep this page as good as it is, read on to learn how you may change that at any time"
    texts = ["".join(rng.choice("xyzw ") for _ in range(300)) + notice + "".join(rng.choice("xyzw ") for _ in range(300)) for _ in range(400)]
    named = spark.createDataFrame(list(enumerate(texts)), "uid long, text string").repartition(8)
    plain = named.mapInArrow(repeats._sample(200, 24, np.empty(0, np.int64)), repeats.TUPLE)
    hot = repeats._frequent(plain)
    assert 1 <= len(hot) <= 1000
    spread = named.mapInArrow(repeats._sample(200, 24, hot), repeats.TUPLE).where(F.col("core").isin(hot.tolist()))
    per_task = spread.repartition(8, "spread").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 2 * sum(r["count"] for r in per_task) / 8


KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def passes(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in KINDS for m in re.finditer(p, text or "") if passes(k, m.group())]


PERSONAL = [
    "a@b.c_d@e.f a@b@c.d x@y. @z.w q.@r-s.t-u.v é😀 me@ex.org",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3 01.02.03.04x999.9.9.9",
    "4111111111111111 4111-1111 1111 1111 4111  1111 1111 1111 5500005555555559 12345678901234567890 4111 1111 1111 1112",
    "+1 (212) 555-0153 +49.30.1234567 +1 2 +12345678901234567 ++44 20 7946 0958) +",
    "0" * 5000 + " 1" * 5000 + "." * 3000 + "a" * 5000 + "@",
]


def test_strict_spans(spark, odd_documents):
    documents = odd_documents.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(PERSONAL, 50)), "doc_id long, text string"))
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    rows = find_personal(documents).collect()
    want = Counter()
    for doc, text in texts:
        spans = base_spans(text)
        counts = [sum(s.startswith(k) for s in spans) for k, _ in KINDS]
        want[(doc, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want
    by = {r.doc_id: r.spans.split(",") for r in rows}
    assert all(set(base_spans(t)) <= set(by[d]) for d, t in texts)


def test_labelers_add_spans(spark):
    """Written-out addresses after a cue are found; the same shape as an order number is not."""
    sure = [(i, f"Contact: user{i}@site{i}.com, phone +1 (212) 555-{1000 + i}.") for i in range(60)]
    loose = [(100 + i, f"my e-mail: someone{i} (at) host{i} (dot) com, phone: (212) 555-{2000 + i}.") for i in range(20)]
    noise = [(200 + i, f"order x 300-555-{3000 + i}a, build 12{i}") for i in range(20)]
    rows = find_personal(spark.createDataFrame(sure + loose + noise, "doc_id long, text string")).collect()
    by = {r.doc_id: r for r in rows}
    assert all(by[100 + i].spans.count(":") == 4 and by[100 + i].n_email == 0 for i in range(20))
    assert all(by[200 + i].spans == "" for i in range(20))


def test_masking(odd_documents):
    masked = mask_personal(odd_documents)
    assert masked.schema.names == odd_documents.schema.names
    old = Counter((r.doc_id, r.text) for r in odd_documents.where("doc_id IS NULL OR doc_id <> 7").collect())
    assert Counter((r.doc_id, r.text) for r in masked.where("doc_id IS NULL OR doc_id <> 7").collect()) == old
    new = masked.where("doc_id = 7").collect()
    assert [r.text for r in new] == ["mail [EMAIL] or [PHONE] at [IP], card [CARD]."] * 2
    assert all(r.n_chars == len(r.text) and r.score == 0.5 and r.fp == "x" for r in new)


def test_whole_table(spark, sd):
    rows = contamination(read(spark, sd, "documents"), read(spark, sd, "benchmark")).collect()
    documents = [(r.doc_id, r.text) for r in read(spark, sd, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, sd, "benchmark").collect()]
    assert Counter(map(tuple, rows)) == Counter(contaminated(documents, items))


def test_one_row_of_each_group_stays(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve thirteen"
    rows = [(1, a, 5), (1, b, 6), (None, a, 7), (None, "none of the other words is here", 8), (None, "none of the other words is here", 9), (2, b, 10), (2, b, 10)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    left = deduplicate(documents)
    assert left.columns == documents.columns
    kept_rows = sorted((r.doc_id or 0, r.text) for r in left.collect())
    assert kept_rows == [(0, rows[3][1]), (1, a), (1, b)]


def test_deeper_trees_find_the_same_links_and_leaves_do_not_grow(spark):
    rng = random.Random(9)
    prints = [rng.getrandbits(64) for _ in range(150)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7))) for p in prints]
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long").distinct()
    found = []
    for levels in (None, 8, 13, 22):
        groups = components(near_links(nodes, levels=levels)).collect()
        found.append({(r.node, r.root) for r in groups})
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) > 100
    depths = [levels_for(n) for n in (0, 1000, 200_000, 800_000, 10**7, 10**12)]
    assert depths == sorted(depths) and depths[0] == 7 and depths[-1] == 22
