"""Near-duplicates by SimHash fingerprints in a forest of vantage-point trees.

A fingerprint's bits are dealt to `BANDS` bands; two fingerprints that differ in at most `radius`
bits differ in at most `radius // BANDS` bits of some band, so each band has a tree of its own and
is searched with that smaller radius. A tree has one vantage point per level (a fixed-queries
tree), a fingerprint of the data, and looks at one group of the band's bits per level: a child is a
ring, the set of fingerprints at one Hamming distance from the vantage point. The triangle
inequality bounds the rings that a fingerprint within the radius can lie in; as the levels look at
different bits, their bounds add up: |ring - ring'| summed over the levels is at most the radius.
All other branches are pruned.

A leaf is a shard. A fingerprint is stored in its own leaf of each tree and visits the leaves that
its ball overlaps; within a leaf exact distances decide. A leaf is cut into blocks of bounded size,
and a task emits no more links than join its fingerprints into components, never all pairs of a
group. Equal fingerprints are one node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.functions.names import unused
from headgate.llm.components import components
from headgate.llm.tables import kept

SHINGLE = 4
RADIUS = 4
SEED = 42
BANDS = 3
#: Levels of a tree for few fingerprints, and how many fingerprints a leaf should hold: more fingerprints get more levels, up to one bit each.
LEVELS = 7
LEAF = 64
#: Stored fingerprints of one leaf that a task compares at once.
BLOCK = 20_000
#: Fingerprints from which the vantage points are chosen; they only steer pruning, never results.
VANTAGE_SAMPLE = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of UTF-8 text, repeats included; 0 without words."""
    words = text.lower().split()  # on bytes: A-Z only, and space, tab to carriage return only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    if len(words) <= shingle:
        pieces = [joined]
    else:
        pieces = [joined[a:b] for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=False)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(pieces), 1 << 15):
        hashes = np.array([digest(p, SEED) for p in pieces[at : at + (1 << 15)]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(pieces), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, fp` per row; fp is the fingerprint's 64 bits as a signed number."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    narrow = documents.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(tasks, f"doc_id {kind}, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


class Tree:
    """Levels of one band: vantage point, bits looked at, and the largest ring of each."""

    def __init__(self, band: list[int], sample: list[int], levels: int):
        groups = [band[i::levels] for i in range(levels)]
        self.masks = [sum(1 << b for b in g) for g in groups if g]
        self.rings = [len(g) for g in groups if g]
        self.vantage = [self._choose(m, sample) for m in self.masks]

    @staticmethod
    def _choose(mask: int, sample: list[int]) -> int:
        """The fingerprint of the sample whose rings are the most even: they prune most."""

        def evenness(v: int) -> tuple[int, int]:
            sizes = np.bincount([((x ^ v) & mask).bit_count() for x in sample])
            return int((sizes**2).sum()), v

        return min(sample[:32], key=evenness, default=0)

    def path(self, fp: Column) -> list[Column]:
        return [F.bit_count(fp.bitwiseXOR(F.lit(_signed(v))).bitwiseAND(F.lit(_signed(m)))) for v, m in zip(self.vantage, self.masks, strict=True)]

    def visits(self, radius: int) -> list[tuple[int, ...]]:
        """Ring differences a visitor may have to its leaf, one of each pair of opposites."""
        within: list[tuple[int, ...]] = [()]
        for _ in self.rings:
            left = [(d, radius - sum(map(abs, d))) for d in within]
            within = [(*d, step) for d, most in left for step in range(-most, most + 1)]
        return [d for d in within if d > (0,) * len(d)]


def levels_for(fingerprints: int, bands: int = BANDS) -> int:
    """As many levels as keep the leaves of evenly spread fingerprints at `LEAF`, whatever their number."""
    width = -(-64 // bands)
    for levels in range(LEVELS, width):
        sizes = [len(range(i, width, levels)) for i in range(levels)]
        same = math.prod(sum(math.comb(b, k) ** 2 for k in range(b + 1)) / 4**b for b in sizes)
        if fingerprints * same <= LEAF:
            return levels
    return width


def forest(sample: list[int], bands: int = BANDS, levels: int = LEVELS) -> list[Tree]:
    cuts = [64 * i // bands for i in range(bands + 1)]
    return [Tree(list(range(a, b)), sample, levels) for a, b in zip(cuts, cuts[1:], strict=False)]


def _leaves(nodes: DataFrame, trees: list[Tree], radius: int) -> DataFrame:
    """`leaf, own, fp`: each fingerprint in its own leaf and the leaves its ball overlaps, per tree."""
    base = 1 + max(r for t in trees for r in t.rings)
    entries: list[Column] = []
    for k, tree in enumerate(trees):
        path = [F.col(f"r{k}_{i}") for i in range(len(tree.rings))]
        nodes = nodes.select("*", *[r.cast("long").alias(f"r{k}_{i}") for i, r in enumerate(tree.path(F.col("fp")))])
        code = F.lit(k).cast("long")
        for ring in path:
            code = code * base + ring
        entries.append(F.struct(code.alias("leaf"), F.lit(True).alias("own")))
        for step in tree.visits(radius):
            moved, inside = 0, F.lit(True)
            for ring, d, most in zip(path, step, tree.rings, strict=True):
                moved = moved * base + d
                if d:
                    inside = inside & (ring + d).between(0, most)
            entries.append(F.when(inside, F.struct((code + moved).alias("leaf"), F.lit(False).alias("own"))))
    return nodes.select("fp", F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.leaf", "e.own", "fp")


def _blocks(leaves: DataFrame, block: int) -> DataFrame:
    """Cut leaves into blocks: a stored row has one, and visits the later ones as visitors visit all."""
    sizes = leaves.where("own").groupBy("leaf").count()
    parts = leaves.join(sizes, "leaf").withColumn("n", F.ceil(F.col("count") / block).cast("int"))
    home = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    first = F.when(F.col("own"), home).otherwise(F.lit(0))
    return (
        parts.withColumn("home", first).withColumn("block", F.explode(F.sequence("home", F.col("n") - 1)))
        .select("leaf", "block", (F.col("own") & (F.col("block") == F.col("home"))).alias("own"), "fp")
    )


def _linked(own: np.ndarray, everything: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that join the rows of one block as all pairs within the radius would; own rows come first."""
    label = np.arange(len(everything))
    step = max(1, (1 << 18) // len(everything))
    for at in range(0, len(own), step):
        near = np.bitwise_count(own[at : at + step, None] ^ everything[None, :]) <= radius
        a, b = np.nonzero(near)
        a += at
        fresh = label[a] != label[b]
        if not fresh.any():
            continue
        root: dict[int, int] = {}
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for x, y, i, j in zip(label[a[fresh]].tolist(), label[b[fresh]].tolist(), a[fresh].tolist(), b[fresh].tolist(), strict=True):
            pairs.setdefault((x, y), (i, j))

        def top(x: int, root: dict[int, int] = root) -> int:
            while x in root:
                x = root[x]
            return x

        for (x, y), (i, j) in pairs.items():
            x, y = top(x), top(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                yield i, j
        merged = np.arange(len(everything))
        for x in root:
            merged[x] = top(x)
        label = merged[label]


def _search(radius: int):
    """Links of the leaves of one partition, read in order; only one block is held at a time."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None

        def links(key: np.ndarray, own: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cuts = np.concatenate(([0], np.nonzero(key[1:] != key[:-1])[0] + 1, [len(key)]))
            found: list[tuple[int, int]] = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                stored = int(own[a:b].sum())
                if stored and b - a > 1:
                    found += [(a + i, a + j) for i, j in _linked(fp[a : a + stored], fp[a:b], radius)]
            at = np.array(found, dtype=np.int64).reshape(-1, 2)
            sides = [pa.array(fp[at[:, s]].view(np.int64)) for s in (0, 1)]
            return pa.RecordBatch.from_arrays(sides, ["a", "b"])

        for batch in batches:
            key = batch.column("leaf").to_numpy() * (1 << 20) + batch.column("block").to_numpy()
            now = (key, batch.column("own").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy().view(np.uint64))
            if rest is not None:
                now = tuple(np.concatenate(x) for x in zip(rest, now, strict=True))
            done = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0  # the last block may go on
            if done:
                yield links(*(x[:done] for x in now))
            rest = tuple(x[done:] for x in now)
        if rest is not None and len(rest[0]):
            yield links(*rest)

    return tasks


def near_links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK, levels: int | None = None) -> DataFrame:
    """`a, b`: links between distinct fingerprints `fp` that join them as all pairs within the radius do."""
    sample = [r[0] & ((1 << 64) - 1) for r in nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(VANTAGE_SAMPLE).collect()]
    levels = levels or levels_for(nodes.count())
    leaves = _blocks(_leaves(nodes.select("fp"), forest(sample, levels=levels), radius // BANDS), block)
    dealt = leaves.repartition("leaf", "block").sortWithinPartitions("leaf", "block", F.col("own").desc())
    return dealt.mapInArrow(_search(radius), "a long, b long").distinct()


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """`doc_id, fingerprint, component_id` for every row of `documents`.

    The component is the smallest `doc_id` reachable over links of fingerprints that differ in at
    most `radius` bits. Null, empty and blank texts have fingerprint zero and are linked like any
    other. Equal texts, repeated rows and ties of distance are ordinary links. A null `doc_id` is
    never smallest; a component of nothing else has a null id. Other columns are left unread, an
    empty table gives no rows.
    """
    printed = kept(fingerprints(documents, shingle), "op3-prints")
    nodes = kept(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "op3-nodes")
    label = kept(components(near_links(nodes, radius, block)), "op3-labels")
    rooted = nodes.join(label, nodes["fp"] == label["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(smallest, "root").select("fp", "component_id")
    return printed.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """One row of each component, with its own columns: that of the smallest `doc_id`, null ids last.

    Of several such rows one stays, whichever was read first. Rows are told apart by where they
    stand, not by their ids: different texts under one id both stay, and copies without an id go.
    """
    row = unused(documents, "_row")
    stamped = kept(documents.withColumn(row, F.monotonically_increasing_id()), "op3-documents")
    prints = kept(fingerprints(stamped.select(F.col(row).alias("doc_id"), "text"), shingle).withColumnRenamed("doc_id", "row"), "op3-prints")
    ids = stamped.select(F.col(row).alias("row"), F.col("doc_id").isNull().alias("nameless"), "doc_id")
    first = F.min(F.struct("nameless", "doc_id", "row")).alias("first")
    nodes = kept(prints.join(ids, "row").groupBy("fp").agg(first), "op3-nodes")
    label = kept(components(near_links(nodes, radius, block)), "op3-labels")
    rooted = nodes.join(label, nodes["fp"] == label["node"], "left").select("first", F.coalesce("root", "fp").alias("root"))
    keep = kept(rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row)), "op3-kept")
    return stamped.join(keep, row, "left_semi").drop(row)
