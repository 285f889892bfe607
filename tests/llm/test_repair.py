"""Conversation repair against plain dynamic programming over whole audits."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from headgate.llm import repair as module
from headgate.llm.repair import damage, repair, reports
from headgate.llm.tables import read

BLANKS = " \t\n\v\f\r"


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def plain_report(turns):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of one conversation's damaged rows."""
    turns = sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, _, role, text in turns:
        body = text.strip(BLANKS)
        kinds.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    numbers = [t for _, t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    # The best (cost, audit, turns) for every state, by the initials so far: "", "s", "u", "a".
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for s, (cost, audit, said) in list(best.items()):
                to = after[s]
                new = (cost + 3, audit + "I", [*said, (names[to], "")])
                best[to] = min(best.get(to, new), new, key=lambda x: x[:2])
        return best

    best = {"": (0, "", [])}
    for (_, _, role, text), kind in zip(turns, kinds, strict=True):
        new = {}

        def offer(s, cost, audit, said, new=new):
            new[s] = min(new.get(s, (cost, audit, said)), (cost, audit, said), key=lambda x: x[:2])

        for s, (cost, audit, said) in inserted(best).items():
            offer(s, cost + 4, audit + "D", said)
            if kind not in ("b", "d"):
                extra = 3 * (kind == "t")
                offer(after[s], cost + 3 + extra, audit + "R", [*said, (names[after[s]], text)])
                if role[:1] == after[s] or (s == "" and role[:1] == "s"):
                    offer(role[:1], cost + extra, audit + "K", [*said, (role, text)])
        best = new
    best = inserted(best)
    cost, audit, said = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said))
    return gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, digest


def plain(rows):
    damaged = plain_damage(rows)
    return {c: plain_report([r for r in damaged if r[0] == c]) for c in {r[0] for r in rows}}


def check(spark, rows):
    table = spark.createDataFrame([(*r, "en", 3, "K", "t") for r in rows], "conv_id long, turn long, role string, text string, lang string, at int, edits string, fault string").repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in reports(repair(damage(table)), table).collect()}
    assert got == plain(rows)


def made(rng, conv_id, n):
    texts = ["Yes.", "No!", "Why? ", "so it goes", "", " \n", "Well...", "é ok.", "Fine.\n", "a?b"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "a", "", None]
    texts = [*texts, *(f"word {i}{rng.choice(['.', '', '!'])}" for i in range(n))]
    return [(conv_id, rng.choice([i, i, i, i + 2, None]), rng.choice(roles) if rng.random() < 0.6 else ["user", "assistant"][i % 2], rng.choice([*texts, None])) for i in range(n)]


def test_registered_table(spark, sd):
    rows = [tuple(r) for r in read(spark, sd, "conversations").select("conv_id", "turn", "role", "text").collect()]
    table = read(spark, sd, "conversations")
    assert {r.conv_id: tuple(r)[1:] for r in reports(repair(damage(table)), table).collect()} == plain(rows)


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_odd_conversations(spark, monkeypatch, block):
    """Conversations of all lengths, cut into small blocks, so that many go over several of them."""
    monkeypatch.setattr(module, "BLOCK", block)
    rng = random.Random(block)
    rows = [r for c in (*range(12), None) for r in made(rng, c, rng.randrange(1, 9))] + made(rng, 50, 150) + [(60, 1, "user", "x " * 50_000)] + [(70, 3, "user", "Again.")] * 30
    check(spark, rows + rows[:3])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert reports(repair(damage(empty)), empty).count() == 0


def test_costs_and_audits_of_long_blocks():
    """The block's vector code against the plain one, without Spark."""
    import pyarrow as pa

    rng = random.Random(1)
    for _ in range(60):
        rows = []
        for c in range(rng.randrange(1, 6)):
            rows += [(c, rng.choice("suax"), rng.choice([None, None, None, "b", "d", "t"])) for _ in range(rng.randrange(1, 30))]
        order = rng.sample(range(len(rows)), len(rows))
        block = module.Block(pa.table({"conv_id": [rows[i][0] for i in order], "at": [10 * i for i in order], "initial": [rows[i][1] for i in order], "fault": [rows[i][2] for i in order]}))
        (found,), _ = block.least_paths(None, False)
        letters = [module.CODES[c][::2] for c in found]
        for c in {r[0] for r in rows}:
            mine = [(kind, initial) for x, initial, kind in rows if x == c]
            got = "".join(x for x, r in zip(letters, rows, strict=True) if r[0] == c)
            assert got == plain_audit(mine)
    assert np.array_equal(module.ENDING, [0, 6, 3, 0])


def plain_audit(rows):
    """The least of the cheapest audits by search over all audits."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}
    for kind, initial in [*rows, (None, None)]:
        for _ in range(3):
            for s, (cost, audit) in list(best.items()):
                best[after[s]] = min(best.get(after[s], (10**9, "")), (cost + 3, audit + "I"))
        if initial is None:
            break
        new = {}
        for s, (cost, audit) in best.items():
            offers = [(s, cost + 4, "D")]
            if kind not in ("b", "d"):
                extra = 3 * (kind == "t")
                offers.append((after[s], cost + 3 + extra, "R"))
                if initial == after[s] or (s == "" and initial == "s"):
                    offers.append((initial, cost + extra, "K"))
            for to, c, letter in offers:
                new[to] = min(new.get(to, (10**9, "")), (c, audit + letter))
        best = new
    return min(best[s] for s in ("", "a") if s in best)[1]
