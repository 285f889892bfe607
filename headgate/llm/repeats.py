"""Exact repeats of byte strings by externally sorted, recursively induced suffix tuples.

A string of `LENGTH` bytes that occurs twice is found without sorting every suffix. Of each window
of `LENGTH` bytes the smallest hashed k-gram is sampled, as a suffix array by induction sorts a
sample of suffixes first: equal windows have equal samples at equal distances, so a sampled suffix
stands for all windows around it. Its tuple is

    core  the hash of the bytes that all windows it stands for have in common,
    ctx   the hash of the bytes that any of them has, with their distances,

and where they are. Tuples are sorted by (core, ctx) in Spark's external sort, which spills sorted
runs to disk and merges them through a priority queue, and are scanned in order. Neighbours tell all: a ctx that comes
twice makes all its windows repeats; a core that comes once makes none of them one; if equal cores
have different ctx, the common bytes end somewhere among the windows, and the tuples are induced
anew for runs of `RUN` windows and then for single ones. A tuple that is decided goes no further,
so the deeper levels only see the edges of repeats. A scan holds one tuple, however many are equal.

Tuples of a core meet in one task, but for cores that a sample of documents shows to be frequent: a
sentence that every page bears has a ctx on every page. Those go by ctx, and as such a task cannot see
the others' ctx, it takes the core to have several. That is a reason to induce anew, never a
decision, so the result is the same whichever cores are thought frequent.

Hashes are 64 bits of content. Documents are known by a hash of id and text, so that nothing but
the document itself has to be kept between the passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headgate.llm.tables import dropped, kept

LENGTH = 200
GRAM = 24
RUN = 16
#: Bytes of a text whose windows are sampled at once.
SEGMENT = 1 << 20
#: Documents sampled, and the share (and least number) of their tuples that makes a core frequent.
SAMPLE = 8192
FREQUENT = 1 / 1000
LEAST = 16
TUPLE = "spread long, core long, ctx long, uid long, p int, lo int, hi int, multi boolean, done boolean"


class Hashes:
    """Polynomial hashes of substrings modulo 2^64 over a fixed random value for each byte."""

    def __init__(self, size: int):
        base = 0x9E3779B97F4A7C15  # fixed value: odd, so that powers can be undone
        self.table = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.up, self.down = np.empty(size + 1, np.uint64), np.empty(size + 1, np.uint64)
        for powers, b in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
            powers[0], powers[1:] = 1, b
            np.multiply.accumulate(powers, out=powers)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Sums of the terms of each prefix, along the last axis."""
        width = data.shape[-1]
        out = np.zeros((*data.shape[:-1], width + 1), np.uint64)
        np.cumsum(self.table[data] * self.up[:width], axis=-1, out=out[..., 1:])
        return out

    @staticmethod
    def mix(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)  # fixed value: odd multiplier
        return h ^ (h >> np.uint64(32))


def sampled(data: np.ndarray, hashes: Hashes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """`core, ctx, p, lo, hi`: sampled places and the first and last window that each stands for."""
    span = length - gram + 1  # k-grams of a window
    sums = hashes.sums(data)
    names = hashes.mix((sums[gram:] - sums[:-gram]) * hashes.down[: len(data) - gram + 1])
    # The smallest name of each window, the leftmost of equal ones: name and place in one number.
    low = np.uint64((1 << 24) - 1)
    key = (names & ~low) | np.arange(len(names), dtype=np.uint64)
    pad = np.full(-len(key) % span, np.iinfo(np.uint64).max)
    rows = np.concatenate((key, pad)).reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    least = (np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows]) & low).astype(np.int64)
    cut = np.nonzero(np.diff(least))[0]
    lo, hi = np.concatenate(([0], cut + 1)), np.concatenate((cut, [windows - 1]))
    p = least[lo]
    around = ((p - lo) * length + (hi - lo)).astype(np.uint64)
    ctx = hashes.mix((sums[hi + length] - sums[lo]) * hashes.down[lo] + hashes.mix(around))
    return names[p], ctx, p, lo, hi


def induced(data: np.ndarray, needs: np.ndarray, hashes: Hashes, length: int, run: int) -> tuple[np.ndarray, ...]:
    """Tuples of runs of `run` windows, by distance from the sampled place, of `needs` (p, lo, hi)."""
    p, lo, hi = needs.T
    first, last = (p - hi) // run, (p - lo) // run
    each = np.repeat(np.arange(len(p)), last - first + 1)
    c = np.arange(len(each)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[each]
    a, b = np.maximum(lo[each], p[each] - run * c - run + 1), np.minimum(hi[each], p[each] - run * c)
    width = int((hi - lo).max()) + length
    local = hashes.sums(data[np.minimum(lo[:, None] + np.arange(width)[None, :], len(data) - 1)])

    def of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (local[each, end - lo[each]] - local[each, start - lo[each]]) * hashes.down[start - lo[each]]

    inner = p[each] - run * c
    core = hashes.mix(of(inner, inner - run + 1 + length) + hashes.mix(c.astype(np.uint64) + np.uint64(run << 32)))
    around = ((p[each] - a) * length + (b - a)).astype(np.uint64)
    return core, hashes.mix(of(a, b + length) + hashes.mix(around)), p[each], a, b


def _batch(columns: list[tuple[np.ndarray, ...]], hot: np.ndarray) -> pa.RecordBatch:
    """Tuples of one batch of documents. Of equal ones all but the first are decided here and now.

    `spread` tells the task: equal tuples meet, and so do those of one core that is not `hot`.
    """
    core, ctx, uid, p, lo, hi = (np.concatenate(c) for c in zip(*columns, strict=True))
    order = np.lexsort((ctx, core))
    core, ctx, uid, p, lo, hi = (x[order] for x in (core, ctx, uid, p, lo, hi))
    same = np.concatenate(([False], (core[1:] == core[:-1]) & (ctx[1:] == ctx[:-1])))
    multi = np.concatenate((same[1:], [False])) & ~same
    # Decided ones only travel on: anywhere, not all to the task of their core.
    away = Hashes.mix(uid.view(np.uint64) + p.astype(np.uint64))
    spread = np.where(same, away, np.where(np.isin(core.view(np.int64), hot), ctx, core))
    numbers = [x.view(np.int64) for x in (spread, core, ctx)] + [uid] + [x.astype(np.int32) for x in (p, lo, hi)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in [*numbers, multi, same]], ["spread", "core", "ctx", "uid", "p", "lo", "hi", "multi", "done"])


def _sample(length: int, gram: int, hot: np.ndarray):
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(SEGMENT + length)
        for batch in batches:
            found, held = [], 0
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                data = np.frombuffer(text.as_buffer() or b"", dtype=np.uint8)
                for at in range(0, len(data) - length + 1, SEGMENT):
                    core, ctx, p, lo, hi = sampled(data[at : at + SEGMENT + length - 1], hashes, length, gram)
                    found.append((core, ctx, np.full(len(p), uid), p + at, lo + at, hi + at))
                    held += len(p)
                if held > 1 << 19:
                    yield _batch(found, hot)
                    found, held = [], 0
            if found:
                yield _batch(found, hot)

    return tasks


def _induce(length: int, run: int, hot: np.ndarray):
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(2 * length)
        for batch in batches:
            found, held = [], 0
            texts = batch.column("text").cast(pa.binary())
            for uid, text, needs in zip(batch.column("uid").to_pylist(), texts, batch.column("needs"), strict=True):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                places = np.stack([needs.values.field(f).to_numpy() for f in ("p", "lo", "hi")], axis=1).astype(np.int64)
                for at in range(0, len(places), 4096):
                    core, ctx, p, lo, hi = induced(data, places[at : at + 4096], hashes, length, run)
                    found.append((core, ctx, np.full(len(p), uid), p, lo, hi))
                    held += len(p)
                    if held > 1 << 19:
                        yield _batch(found, hot)
                        found, held = [], 0
            if found:
                yield _batch(found, hot)

    return tasks


def _scan(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """`uid, p, lo, hi, need`: windows that repeat, and (need) those that are still to be told.

    Tuples come in order of core and ctx. What is carried to the next batch is the last tuple and
    whether its core has come with another ctx. Other tasks may hold more of a `hot` core.
    """
    names = ("core", "ctx", "uid", "p", "lo", "hi", "multi")
    carry, mixed_before = None, False

    def out(x: dict[str, np.ndarray], rows: np.ndarray, need: bool) -> pa.RecordBatch:
        arrays = [pa.array(x[c][rows]) for c in ("uid", "p", "lo", "hi")] + [pa.array(np.full(int(rows.sum()), need))]
        return pa.RecordBatch.from_arrays(arrays, ["uid", "p", "lo", "hi", "need"])

    def told(x: dict[str, np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal carry, mixed_before
        core, ctx = x["core"], x["ctx"]
        fresh = np.concatenate(([True], core[1:] != core[:-1]))  # begins a core
        head = fresh | np.concatenate(([True], ctx[1:] != ctx[:-1]))  # begins a ctx
        kind, group = np.cumsum(head) - 1, np.cumsum(fresh) - 1
        multi = (np.bincount(kind) > 1) | (np.bincount(kind, weights=x["multi"]) > 0)
        mixed = (np.bincount(group[head]) > 1) | np.isin(core[fresh], hot)
        if mixed_before:
            mixed[0] = True
        ready = head.copy()
        if not last:  # the last ctx may go on
            final = np.nonzero(head)[0][-1]
            carry = {c: x[c][final : final + 1] for c in names}
            carry["multi"] = np.array([multi[-1]])
            ready[final] = False
        yield out(x, (ready & multi[kind]) | ~head, False)
        yield out(x, ready & mixed[group], True)
        mixed_before = bool(mixed[-1])

    for batch in batches:
        done = batch.column("done").to_numpy(zero_copy_only=False)
        x = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if done.any():
            yield out(x, done, False)
            x = {c: v[~done] for c, v in x.items()}
        if not len(x["core"]):
            continue
        if carry is not None:
            x = {c: np.concatenate((carry[c], x[c])) for c in names}
        yield from told(x, False)
    if carry is not None:
        yield from told(carry, True)


def _frequent(tuples: DataFrame) -> np.ndarray:
    """Cores that many tuples of a sample bear, sorted; at most 1 / `FREQUENT` of them."""
    # Equal tuples of a batch are one already; of the others it is the number of ctx that counts.
    per_core = tuples.where("NOT done").groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    total = F.lit(FREQUENT) * tuples.where("NOT done").count()
    return np.array(sorted(r.core for r in per_core.where(F.col("n") > total).collect()), dtype=np.int64)


def _told(texts: DataFrame, sample: DataFrame, tasks, name: str) -> DataFrame:
    """The tuples that `tasks(hot)` cuts from texts, told; a sample of the texts says which cores are hot."""
    hot = _frequent(sample.mapInArrow(tasks(np.empty(0, np.int64)), TUPLE))
    ordered = texts.mapInArrow(tasks(hot), TUPLE).repartition("spread").sortWithinPartitions("core", "ctx")
    return kept(ordered.mapInArrow(lambda batches: _scan(batches, hot), "uid long, p int, lo int, hi int, need boolean"), name)


def _kept_bytes(length: int, kind: str):
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.binary())
            for text, spans in zip(texts, batch.column("spans"), strict=True):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                edges = np.zeros(len(data) + 1, np.int32)
                np.add.at(edges, spans.values.field("lo").to_numpy(), 1)
                np.add.at(edges, spans.values.field("hi").to_numpy() + length, -1)
                gone = np.cumsum(edges[:-1]) > 0
                starts = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((len(data), int(gone.sum()), starts, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 4
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return tasks, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeated_windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, run: int = RUN) -> DataFrame:
    """`uid, spans`: first and last windows (`lo, hi`) of runs of windows that occur elsewhere too.

    `texts` has `uid, text`. Rows of one uid are taken to be copies of one text.
    """
    share = min(1.0, SAMPLE / max(texts.count(), 1))
    some = kept(texts.sample(share, seed=10), "op10-texts")
    told = [_told(texts, some, lambda hot: _sample(length, gram, hot), "op10-sampled")]
    for k, size in enumerate((run, 1)):
        places = F.collect_list(F.struct("p", "lo", "hi")).alias("needs")
        needs = told[-1].where("need").distinct().groupBy("uid").agg(places)
        all_, few = (t.join(needs, "uid").select("uid", "text", "needs") for t in (texts, some))
        told.append(_told(all_, few, lambda hot, size=size: _induce(length, size, hot), f"op10-induced{k}"))
    found = told[0]
    for more in told[1:]:
        found = found.union(more)
    # At the last level a tuple is one window: core and ctx say the same.
    spans = found.where("NOT need").groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    spans = kept(spans, "op10-spans")
    for table in [*told, some]:
        dropped(table)
    return spans


def without_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, run: int = RUN) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256` for every row of `documents`.

    Removed is every byte in a string of `length` bytes that also starts anywhere else in the
    documents, the same one included. A null text is empty; texts shorter than `length` keep all.
    Repeated rows repeat each other. Rows with null ids are documents like any other. Other columns
    are left unread; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    named = documents.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("uid"))
    spans = repeated_windows(named.select("uid", "text"), length, gram, run)
    tasks, schema = _kept_bytes(length, documents.schema["doc_id"].dataType.simpleString())
    cut = named.join(spans, "uid").select("doc_id", "text", "spans").mapInArrow(tasks, schema)
    size, none = F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long")
    digests = named.select("uid", "doc_id", size, F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
    whole = digests.join(spans.select("uid"), "uid", "left_anti")
    return cut.union(whole.select("doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), "kept_sha256"))
