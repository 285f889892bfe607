"""Repair of conversations: the cheapest edits that give a legal order of roles, and of those the least audit.

The turns are sorted once into ranges, so that a conversation of any length lies in consecutive blocks
of rows. A row is a matrix of the least costs from each state of the role grammar to each other one;
products of these matrices (least sum instead of sum of products) are the costs of longer stretches.
They are made by doubling: within a block over its rows, between blocks over the one conversation that
goes on from a block into the next. So every block learns what it costs to end the conversation after it.

Then the least audit. A node is a row and a state before it, an arc an edit that keeps to the least
cost. Nodes are ranked by the audits of 1, 2, 4, ... letters that begin in them: the rank for twice the
length comes from a node's rank and the rank of the node that its pointer reaches. The letters of the
arcs that leave a node differ, so a least audit of any length ends in one node, and pointers double with
the ranks. Every node takes its least arc by letter and then rank, and the doubled pointers mark the
nodes on the path from the first state. A block that begins inside a conversation does so from each
state; which one holds is found by composing the blocks' maps from state to state, again by doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.llm.tables import dropped, kept

#: Rows of a block, the most that one task holds at once.
BLOCK = 1 << 16
#: What edits cost, and a truncated row that is not deleted.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: States of the role grammar `(s?(ua)+)?`: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant turn that fits, which is the only turn that can be inserted or reroled to.
FIT = np.array([USER, USER, ASSISTANT, USER])
INFINITE = 1 << 50
#: What it costs to end in each state, by inserting what is missing.
ENDING = np.array([0, 2 * INSERT, INSERT, 0])
#: The state after keeping a row whose role begins with s, u, a or another letter; -1 where it does not fit.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: What one row's code says: inserts before it, its own edit, inserts after it; each edit a letter and a role, `=` the row's own, `-` none.
BEFORE, OWN, AFTER = ("", "Iu", "Ia", "IuIa"), ("D-", "K=", "Ru", "Ra"), ("", "Ia", "IuIa")
CODES = [b + o + a for b in BEFORE for o in OWN for a in AFTER]
SPACE = r"\x20\x09-\x0D"


# ---- faults


def damage(conversations: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text` with faults put in by a checksum of conversation and turn; nulls read as one space."""
    c = conversations.select("conv_id", "turn", *(F.coalesce(x, F.lit(" ")).alias(x) for x in ("role", "text")))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    c = c.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return c.drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """`turns` as a table in order of conversation and turn, with the place `at` and the text's digest.

    Turns are in order, nulls first; equal ones by role, then digest. Equal rows are told apart by
    where they were read, so that a range never has to hold all of them.
    """
    keys = ["conv_id", "turn", "role", "digest", "read"]
    rows = turns.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("read"))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return kept(rows.select("conv_id", "turn", "role", "text", "digest", F.monotonically_increasing_id().alias("at")), "op11-turns")


def faults(turns: DataFrame) -> DataFrame:
    """`conv_id, at, initial, fault`: the first of blank (b), duplicate (d), truncated (t) that holds, else null."""
    rows = turns.select("conv_id", "at", "role", "digest", F.when(~F.col("text").rlike(f"[^{SPACE}]"), "b").when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "t").alias("own"))
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv_id", "role", "digest")]
    fault = F.when(F.col("own") == "b", "b").when(F.col("at") > F.col("first"), "d").otherwise(F.col("own"))
    return rows.alias("r").join(firsts.alias("f"), same, "left").select("r.conv_id", "at", F.substring("r.role", 1, 1).alias("initial"), fault.alias("fault"))


# ---- one block


class Block:
    """The rows of a block in order, cut into segments, one for each conversation."""

    def __init__(self, table: pa.Table):
        self.order = np.argsort(table["at"].to_numpy(), kind="stable")
        ids = [table["conv_id"][int(i)].as_py() for i in self.order]
        self.at = table["at"].to_numpy()[self.order]
        take = lambda name: [(x or "") for x in table[name].take(pa.array(self.order)).to_pylist()]
        self.initial = np.array([{"s": 0, "u": 1, "a": 2}.get(x, 3) for x in take("initial")], dtype=int)
        fault = np.array(take("fault"))
        self.gone, self.short = np.isin(fault, ["b", "d"]), (fault == "t").astype(np.int64)
        self.firsts = np.array([i for i, x in enumerate(ids) if i == 0 or x != ids[i - 1]])
        self.lasts = np.append(self.firsts[1:], len(ids)) - 1
        self.ends = (ids[0], ids[-1])
        self.segment = np.repeat(np.arange(len(self.firsts)), self.lasts - self.firsts + 1)

    def steps(self) -> np.ndarray:
        """The least cost from state to state over each row, with inserts before it."""
        n, rows = len(self.at), np.arange(len(self.at))
        cost = np.full((n, 4, 4), INFINITE, dtype=np.int64)
        for s in range(4):
            state, spent = s, 0
            for _ in range(3):
                cost[:, s, state] = np.minimum(cost[:, s, state], spent + DELETE)
                to = KEPT[state][self.initial]
                can = ~self.gone & (to >= 0)
                np.minimum.at(cost, (rows[can], s, to[can]), spent + TRUNCATED * self.short[can])
                to = FIT[state]
                cost[~self.gone, s, to] = np.minimum(cost[~self.gone, s, to], spent + REROLE + TRUNCATED * self.short[~self.gone])
                state, spent = to, spent + INSERT
        return cost

    def costs(self) -> np.ndarray:
        """The least cost from state to state from each row to the end of its segment, by doubling."""
        cost, after = self.steps(), np.where(np.arange(len(self.at)) == self.lasts[self.segment], -1, np.arange(len(self.at)) + 1)
        while (go := np.nonzero(after >= 0)[0]).size:
            cost[go] = np.minimum((cost[go][:, :, :, None] + cost[after[go]][:, None, :, :]).min(axis=2), INFINITE)
            after[go] = after[after[go]]
        return cost

    def least_paths(self, leaving: np.ndarray | None, entered: bool) -> tuple[list[np.ndarray], list[int]]:
        """Codes of all rows and the last state, for each state before the first row: one, or four if the block is `entered`.

        `leaving` is the cost after each state at the block's end if its last conversation goes on.
        """
        n, groups = len(self.at), len(self.firsts)
        end = np.tile(ENDING, (groups, 1)).astype(np.int64)
        if leaving is not None:
            end[-1] = leaving
        after = (self.costs() + end[self.segment][:, None, :]).min(axis=2)
        # Nodes are four for each row, then four for the end of each segment.
        cost = np.concatenate([after.ravel(), end.ravel()])
        state = np.tile(np.arange(4), n + groups)
        row = np.arange(4 * n) // 4
        beyond = np.where(row == self.lasts[self.segment[row]], 4 * (n + self.segment[row]), 4 * (row + 1))
        inserted = np.arange(4 * (n + groups)) - state + FIT[state]
        to = np.tile(np.arange(4 * (n + groups)), (4, 1))  # by letter: D, I, K, R
        arc = np.zeros(to.shape, dtype=bool)
        mine, stays = state[: 4 * n], ~self.gone[row]
        fits = KEPT[mine, self.initial[row]]
        to[0, : 4 * n], to[2, : 4 * n], to[3, : 4 * n] = beyond + mine, beyond + np.maximum(fits, 0), beyond + FIT[mine]
        to[1] = inserted
        here, extra = cost[: 4 * n], TRUNCATED * self.short[row]
        arc[0, : 4 * n] = here == DELETE + cost[to[0, : 4 * n]]
        arc[1] = cost == INSERT + cost[inserted]
        arc[2, : 4 * n] = stays & (fits >= 0) & (here == extra + cost[to[2, : 4 * n]])
        arc[3, : 4 * n] = stays & (here == REROLE + extra + cost[to[3, : 4 * n]])
        if leaving is not None:
            arc[1, -4:] = False  # these inserts belong to the next block
        letter = np.where(arc.any(axis=0), arc.argmax(axis=0) + 1, 0)
        pointer = np.where(letter > 0, np.take_along_axis(to, np.maximum(letter - 1, 0)[None], axis=0)[0], np.arange(to.shape[1]))
        rank, pointers = letter, [pointer]
        while (pointers[-1][pointers[-1]] != pointers[-1]).any():
            rank = np.unique(rank * (rank.max() + 1) + rank[pointers[-1]], return_inverse=True)[1]
            pointers.append(pointers[-1][pointers[-1]])
        span = np.int64(rank.max() + 1)
        best = np.where(arc, np.arange(1, 5)[:, None] * span + rank[to], 5 * span).argmin(axis=0)
        best = np.where(arc.any(axis=0), best, -1)
        starts = 4 * self.firsts
        paths = [self._codes(best, pointers, np.append(starts[1:], s)) for s in (range(4) if entered else (START,))]
        return [c for c, _ in paths], [s for _, s in paths]

    def _codes(self, best: np.ndarray, pointers: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, int]:
        n = len(self.at)
        on = np.zeros(len(best), dtype=bool)
        on[starts] = True
        for pointer in reversed(pointers):
            on[pointer[np.nonzero(on)[0]]] = True
        path, chosen = on.reshape(-1, 4), best.reshape(-1, 4)
        inserts = path & (chosen == 1)
        count = inserts.sum(axis=1)
        # One insert is an assistant's after a user; two are a user and an assistant.
        said = np.where(count == 2, 3, np.where(count == 1, np.where(inserts[:, USER], 2, 1), 0))
        own_state = (path & (chosen != 1)).argmax(axis=1)[:n]
        own = chosen[:n][np.arange(n), own_state]
        own = np.where(own == 0, 0, np.where(own == 2, 1, np.where(FIT[own_state] == USER, 2, 3)))
        closing = np.zeros(n, dtype=int)
        closing[self.lasts] = np.where(said[n:] == 3, 2, np.where(said[n:] == 2, 1, 0))
        return (said[:n] * len(OWN) + own) * len(AFTER) + closing, int((path[-1] & (chosen[-1] == -1)).argmax())


# ---- all blocks


def _by_block(rows: DataFrame) -> DataFrame:
    """Rows with the number of their block: consecutive in order, whatever the partitions. One count per partition reaches the driver."""
    sizes = {r["p"]: r["n"] for r in rows.groupBy(F.shiftright("at", 33).cast("int").alias("p")).agg((F.max(F.col("at").bitwiseAND((1 << 33) - 1)) + 1).alias("n")).collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        starts.append(total)
        total += -(-sizes.get(p, 0) // BLOCK)
    start = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    return rows.withColumn("block", F.get(start, F.shiftright("at", 33).cast("int")) + F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / BLOCK))


def _ends(rows: DataFrame) -> DataFrame:
    """`block, first, last, whole, cost`: a block's first and last conversation, whether they are one, and the cost matrix of its first segment."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def ends(table: pa.Table) -> pa.Table:
        block = Block(table)
        head = Block(table.take(pa.array(block.order[: block.lasts[0] + 1])))
        cost = head.costs()[0].ravel()
        ids = [pa.array([x], table.schema.field("conv_id").type) for x in block.ends]
        return pa.table({"block": table["block"].slice(0, 1), "first": ids[0], "last": ids[1], "whole": [len(block.firsts) == 1], "cost": pa.array([cost.tolist()], pa.list_(pa.int64()))})

    return rows.groupBy("block").applyInArrow(ends, f"block long, first {kind}, last {kind}, whole boolean, cost array<bigint>")


def _product(a: Column, b: Column) -> Column:
    """The least sums over the middle state of two matrices of sixteen costs."""
    one = lambda i, k: F.get(a, F.floor(i / 4).cast("int") * 4 + k) + F.get(b, F.lit(4) * k + i % 4)
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.least(F.lit(INFINITE).cast("bigint"), *[one(i, k) for k in range(4)]))


def _doubled(links: DataFrame, merge, name: str) -> DataFrame:
    """`block, value` of chains (`block`, `next`, `value`): all values from a block to its chain's end merged, in log2 of the longest chain rounds."""
    links, n = kept(links, name), 0
    while links.where("next IS NOT NULL").limit(1).count():
        ahead = links.select(F.col("block").alias("b"), F.col("next").alias("n"), F.col("value").alias("v"))
        more = links.join(ahead, F.col("next") == F.col("b"), "left")
        n += 1
        further = kept(more.select("block", F.col("n").alias("next"), F.when(F.col("b").isNull(), F.col("value")).otherwise(merge(F.col("value"), F.col("v"))).alias("value")), f"{name}-{n}")
        dropped(links)
        links = further
    return links.select("block", "value")


def codes(rows: DataFrame) -> DataFrame:
    """`at, code` for rows (`conv_id`, `at`, `initial`, `fault`) in the order of `at`: the place in `CODES` of each row's edits."""
    rows = kept(_by_block(rows), "op11-rows")
    ends = kept(_ends(rows), "op11-ends")
    following = ends.select((F.col("block") - 1).alias("block"), F.col("first").alias("next_first"), F.lit(True).alias("follows"))
    goes_on = F.coalesce(F.col("follows"), F.lit(False)) & F.col("last").eqNullSafe(F.col("next_first"))
    linked = kept(ends.join(following, "block", "left").select("block", "whole", "cost", goes_on.alias("goes_on")), "op11-links")
    onward = F.when(F.col("whole") & F.col("goes_on"), F.col("block") + 1)
    suffix = _doubled(linked.select("block", onward.alias("next"), F.col("cost").alias("value")), _product, "op11-costs")
    # The cost of all that follows a block, by the state at its end, and whether a block begins inside a conversation.
    to_end = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda e: F.get("value", s * 4 + e) + F.get(F.array(*map(F.lit, ENDING.tolist())), e))))
    leaving = suffix.select((F.col("block") - 1).alias("block"), to_end.alias("leaving"))
    entered = linked.where("goes_on").select((F.col("block") + 1).alias("block"), F.lit(True).alias("entered"))
    around = linked.where("goes_on").join(leaving, "block").select("block", "leaving").join(entered, "block", "full")
    around = kept(around.select("block", "leaving", F.coalesce("entered", F.lit(False)).alias("entered")), "op11-around")

    def solve(table: pa.Table, near: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "at": pa.array([], pa.int64()), "code": pa.array([], pa.list_(pa.int32()))})
        outside = near.to_pylist()[0] if near.num_rows else {"leaving": None, "entered": False}
        block = Block(table)
        found, last = block.least_paths(None if outside["leaving"] is None else np.array(outside["leaving"]), outside["entered"])
        # The rows after a first segment that came from before are the same for each state there.
        many = block.lasts[0] + 1 if outside["entered"] else 0
        code = np.stack(found, axis=1)
        offsets = np.concatenate([np.arange(many) * len(found), many * len(found) + np.arange(len(code) - many + 1), []]).astype(np.int32)
        flat = np.concatenate([code[:many].ravel(), code[many:, 0]]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        states = pa.array([last if len(block.firsts) == 1 else [last[0]]], pa.list_(pa.int32()))
        number = pa.array(np.full(len(code) + 1, table["block"][0].as_py()), pa.int64())
        return pa.table({"block": number, "at": pa.concat_arrays([pa.array(block.at, pa.int64()), pa.nulls(1, pa.int64())]), "code": pa.concat_arrays([lists, states])})

    solved = kept(rows.groupBy("block").cogroup(around.groupBy("block")).applyInArrow(solve, "block long, at long, code array<int>"), "op11-codes")
    # A block of one conversation that came from before leaves in a state that depends on how it was entered.
    left = solved.where("at IS NULL").select("block", F.when(F.size("code") > 1, F.col("block") - 1).alias("next"), F.col("code").alias("value"))
    left = _doubled(left, lambda mine, before: F.transform(before, lambda s: F.get(mine, s)), "op11-states")
    entry = left.select((F.col("block") + 1).alias("block"), F.get("value", F.lit(0)).alias("entry"))
    picked = F.when(F.size("code") == 1, F.get("code", F.lit(0))).otherwise(F.get("code", F.col("entry")))
    return solved.where("at IS NOT NULL").join(entry, "block", "left").select("at", picked.alias("code"))


def repair(turns: DataFrame) -> DataFrame:
    """`conv_id, at, turn, role, text, fault, edits` for every row of `turns` (`conv_id`, `turn`, `role`, `text`), in the order of `at` within a conversation.

    `fault` is the row's first of blank (b), duplicate (d) and truncated (t), else null. `edits` holds
    letter and role of what to do there, in order: `Iu` and `Ia` insert an empty turn of the user or
    the assistant, `Ru` and `Ra` give the row that role, `K=` keeps it, `D-` deletes it. They are the
    cheapest that make the roles' initials `(s?(ua)+)?`, of equally cheap ones those with the least
    letters. Nulls in role and text read as one space, rows without a conversation are one, rows
    without a turn come first; an empty table gives no rows. Other columns are left unread.
    """
    filled = turns.select("conv_id", "turn", *(F.coalesce(x, F.lit(" ")).alias(x) for x in ("role", "text")))
    table = ordered(filled)
    rows = kept(faults(table), "op11-faults")
    edits = F.get(F.array(*map(F.lit, CODES)), F.col("code")).alias("edits")
    told = rows.join(codes(rows), "at").select("at", "fault", edits)
    return table.join(told, "at").select("conv_id", "at", "turn", "role", "text", "fault", "edits")


def turns_of(role: str, text: str, edits: str) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that a row's edits leave."""
    for letter, to in zip(edits[::2], edits[1::2], strict=True):
        if letter != "D":
            name = role if to == "=" else {"u": "user", "a": "assistant"}[to]
            yield name, "" if letter == "I" else text


class Digest:
    """What is reported of one conversation, whose rows come one by one in order."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.sha, self.before, self.any = conv_id, [], hashlib.sha256(), None, False
        self.n = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.cost = self.distinct = 0
        self.lowest = self.turn = None

    def add(self, turn: int | None, role: str, text: str, fault: str | None, edits: str) -> None:
        if fault:
            self.n[fault] += 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.distinct, self.turn = self.distinct + 1, turn
            self.lowest = turn if self.lowest is None else self.lowest
        letters = edits[::2]
        self.audit.append(letters)
        self.cost += DELETE * letters.count("D") + REROLE * letters.count("R") + INSERT * letters.count("I") + TRUNCATED * (fault == "t" and "D" not in letters)
        for name, said in turns_of(role, text, edits):
            self.sha.update((("\n" if self.any else "") + f"{name}:{said}").encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.lowest is None else self.turn - self.lowest + 1 - self.distinct
        return (self.conv_id, gaps, self.n["b"], self.n["d"], self.n["t"], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def reports(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each `conv_id` of `conversations`: faults, cost, audit and hash of its rows in `repaired`.

    The hash runs over a whole conversation's text, which has to pass through one task in order; it is
    read as a stream, and nothing of it is held but the letters of the audit.
    """
    kind = repaired.schema["conv_id"].dataType

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv_id, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "edits")), strict=True):
                if now is None or now.conv_id != conv_id:
                    done += [now.row()] if now else []
                    now = Digest(conv_id)
                now.add(*row)
            if done:
                yield _batch(done, batch.schema.field("conv_id").type)
                done = []
        if now:
            yield _batch([now.row()], batch.schema.field("conv_id").type)

    inner = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    found = inner.mapInArrow(digest, f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")
    all_ids = conversations.select("conv_id").distinct()
    every = all_ids.alias("a").join(found.alias("f"), F.col("a.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS]
    return every.select("a.conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
