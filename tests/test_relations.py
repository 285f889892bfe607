import random

import pytest
from pyspark.sql import functions as F

from headgate.operators.aggregates import ordered_text_parts
from headgate.operators.constraints import (
    ForeignKey,
    Relation,
    check_violations,
    duplicates,
    foreign_key_report,
    key_report,
    orphans,
    profile_rows,
    relationship_edges,
)
from headgate.operators.graph import group_report, manifest_walk, resume_traversal, traverse
from headgate.operators import graph, intervals
from headgate.operators.intervals import interval_join
from headgate.operators.joins import array_member_counts, array_member_join, left_chain_counts
from headgate.session import settings, workspace


@pytest.mark.parametrize("seed", range(3))
def test_interval_join_agrees_with_brute_force(spark, seed, monkeypatch):
    if seed:  # so few rows a task that buckets and the hot key are split
        monkeypatch.setattr(intervals, "LEAST_ROWS", 10 * seed)
        monkeypatch.setattr(intervals, "MOST_ROWS", 10 * seed)
        monkeypatch.setattr("headgate.plans.rows.MIN_ROWS_PER_BUCKET", 20)
    rng = random.Random(seed)
    keys = [rng.randrange(-500, 5000) for _ in range(300)] + [42] * 150
    spans = [1, 2, 3, 7, 64, 65, 1000, 6000]
    ranges = [(i, lo := rng.randrange(-600, 5000), lo + rng.choice(spans)) for i in range(80)]
    ranges += [(900, 100, 100), (901, 200, 50), (902, 4000, None)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id INT, k BIGINT")
    table = spark.createDataFrame(ranges, "r INT, lo BIGINT, hi BIGINT")
    got = sorted((x.id, x.r) for x in interval_join(rows, "k", table, "lo", "hi").select("id", "r").collect())
    assert got == sorted((i, r) for i, k in enumerate(keys) for r, lo, hi in ranges if lo <= k and (hi is None or k < hi))


def test_a_hot_key_is_dealt_out_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(intervals, "LEAST_ROWS", 100)
    monkeypatch.setattr(intervals, "MOST_ROWS", 100)
    rows = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id ELSE 500 END AS k")
    ranges = spark.createDataFrame([(1, 0, None), (2, 400, 600), (3, 500, 501)], "r INT, lo BIGINT, hi BIGINT")
    joined = interval_join(rows, "k", ranges, "lo", "hi")
    assert joined.count() == 3000 + 2000 + 66 + 2000
    cuts = spark.createDataFrame([(0, 0, 20), (500, 1, 30)], "cut BIGINT, at BIGINT, parts BIGINT")
    placed = intervals.as_of(rows, "k", cuts, intervals.plan_rows(cuts, "cut"), ["at", "parts"])
    dealt = placed.select("at", intervals._spread(F.col("parts")).alias("p")).groupBy("at", "p").count()
    hot = [r["count"] for r in dealt.where("at = 1").collect()]
    assert len(hot) == 30 and max(hot) < 2 * sorted(hot)[15]


def test_interval_join_of_int_keys_to_wide_ranges(spark):
    rows = spark.createDataFrame([(-5,), (7,), (2147483647,)], "k INT")
    table = spark.createDataFrame([(1, -10**12, 10**12), (2, 0, 10**10), (3, 7, 8)], "r INT, lo BIGINT, hi BIGINT")
    got = sorted((x.k, x.r) for x in interval_join(rows, "k", table, "lo", "hi").collect())
    assert got == [(-5, 1), (7, 1), (7, 2), (7, 3), (2147483647, 1), (2147483647, 2)]


def test_interval_join_without_ranges(spark):
    empty = spark.createDataFrame([], "r INT, lo BIGINT, hi BIGINT")
    assert interval_join(spark.range(5), "id", empty, "lo", "hi").count() == 0


def test_interval_join_over_the_whole_bigint_range(spark):
    top = (1 << 63) - 1
    rows = spark.createDataFrame([(-top - 1,), (0,), (top - 1,)], "k BIGINT")
    table = spark.createDataFrame([(1, -top - 1, top), (2, 0, 1)], "r INT, lo BIGINT, hi BIGINT")
    got = sorted((x.k, x.r) for x in interval_join(rows, "k", table, "lo", "hi").collect())
    assert got == [(-top - 1, 1), (0, 1), (0, 2), (top - 1, 1)]


def test_array_members_count_once(spark):
    rows = spark.createDataFrame([(1, [1, 1, 2]), (2, []), (3, None), (4, [9])], "id INT, ks ARRAY<INT>")
    other = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, name STRING")
    assert sorted((r.id, r.name) for r in array_member_join(rows, "ks", other, "k").collect()) == [(1, "a"), (1, "b")]
    counts = array_member_counts(rows, "ks", other, "k", F.min("id").alias("first"))
    assert sorted(tuple(r) for r in counts.collect()) == [(1, "a", 1, 1), (2, "b", 1, 1)]


def test_left_chain_keeps_parents_without_children(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "p INT")
    child = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "c INT, cp INT")
    grand = spark.createDataFrame([(10,), (10,), (10,)], "gc INT")
    got = left_chain_counts(parent, "p", child, "c", "cp", grand, "gc")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, 3), (2, 1, 0), (3, 0, 0)]


def test_key_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 3)], "a INT, b INT")
    row = key_report(df, ["a", "b"], "t").first()
    assert (row.row_count, row.distinct_keys, row.repeated_keys, row.null_rows, row.is_key) == (4, 3, 1, 1, False)
    good = key_report(spark.range(10), ["id"], "t").first()
    assert good.is_key and good.distinct_keys == 10
    assert key_report(spark.range(0), ["id"], "t").first().is_key


def test_unique_and_check_let_null_pass(spark):
    df = spark.createDataFrame([(1, 5), (1, 50), (None, 1), (None, 1), (2, None)], "a INT, b INT")
    assert [(r.a, r.copies) for r in duplicates(df, ["a"]).collect()] == [(1, 2)]
    assert duplicates(df, ["a"], F.col("b") > 10).count() == 0
    assert [r.b for r in check_violations(df, F.col("b") < 10).collect()] == [50]


def test_composite_foreign_key(spark):
    child = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "x"), (2, None)], "a INT, b STRING")
    parent = spark.createDataFrame([(1, "y")], "pa INT, pb STRING")
    fk = ForeignKey("f", child, ["a", "b"], parent, ["pa", "pb"])
    assert [tuple(r) for r in orphans(fk).collect()] == [(1, "x", 2)]
    assert tuple(foreign_key_report([fk]).first()) == ("f", 1, 2)


def test_profile(spark):
    df = spark.createDataFrame([("abc", None), (None, None)], "s STRING, d DECIMAL(9,2)")
    rows = profile_rows(df, "t").orderBy("ordinal").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (1, "s", "string", "STRING", None, None, 3, 1),
        (2, "d", "decimal(9,2)", "DECIMAL", 9, 2, None, 2),
    ]


def edges_of(spark, pairs):
    return spark.createDataFrame([("n", a, "n", b) for a, b in pairs], "src_entity STRING, src_key STRING, dst_entity STRING, dst_key STRING")


def roots_of(spark, keys):
    return spark.createDataFrame([("n", k, g) for k, g in keys], "entity STRING, key STRING, group_id STRING")


def walk(pairs, roots, max_depth):
    """Breadth-first search in plain Python."""
    found, level, depth = {}, {}, 0
    for k, g in roots:
        level[k] = min(g, level.get(k, g))
    while level:
        found.update({k: (depth, g) for k, g in level.items()})
        if max_depth is not None and depth >= max_depth:
            break
        nxt = {}
        for a, b in pairs:
            if a in level and b not in found:
                nxt[b] = min(level[a], nxt.get(b, level[a]))
        level, depth = nxt, depth + 1
    return found


@pytest.mark.parametrize(("seed", "limit"), [(0, None), (1, 2), (2, None)])
def test_traversal_agrees_with_plain_search(spark, seed, limit):
    rng = random.Random(seed)
    pairs = [(str(rng.randrange(60)), str(rng.randrange(60))) for _ in range(90)]
    pairs += [("0", str(i)) for i in range(30, 60)] + [("5", "5"), ("6", "0")]
    roots = [("0", "b"), ("1", "a"), ("1", "c")]
    hot = 4 if seed else 1_000_000  # so few that nodes with many edges are split
    got = traverse(edges_of(spark, pairs), roots_of(spark, roots), limit, hot_edges=hot)
    assert {r.key: (r.depth, r.group_id) for r in got.collect()} == walk(pairs, roots, limit)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("headgate_")]


def test_resumed_traversal_is_the_uninterrupted_one(spark):
    pairs = [(str(i), str(i + 1)) for i in range(6)] + [("2", "9"), ("6", "0")]
    state = workspace(spark, "test-resume")
    first = traverse(edges_of(spark, pairs), roots_of(spark, [("0", "g")]), 2, state)
    assert first.agg(F.max("depth")).first()[0] == 2
    # A later level that a crashed run left behind must not count.
    spark.createDataFrame([("n", "77", "g")], "entity STRING, key STRING, group_id STRING").write.parquet(f"{state}/nodes/depth=9")
    got = resume_traversal(spark, state, 2, 5)
    assert {r.key: (r.depth, r.group_id) for r in got.collect()} == walk(pairs, [("0", "g")], 5)


def test_groups_that_ended_are_completed(spark):
    pairs = [("a", "a1"), ("b", "b1"), ("b1", "b2"), ("b2", "b3")]
    nodes = traverse(edges_of(spark, pairs), roots_of(spark, [("a", "a"), ("b", "b")]), 2)
    got = {r.group_id: (r.nodes, r.deepest, r.completed) for r in group_report(nodes, 2).collect()}
    assert got == {"a": (2, 1, True), "b": (3, 2, False)}


@pytest.mark.parametrize("seed", [0, 1])
def test_every_group_has_its_whole_subgraph(spark, seed):
    rng = random.Random(seed)
    pairs = [(str(rng.randrange(40)), str(rng.randrange(40))) for _ in range(70)]
    roots = [("0", "b"), ("1", "a"), ("1", "c"), ("2", "b")]
    got = traverse(edges_of(spark, pairs), roots_of(spark, roots), 5, by_group=True)
    want = {}
    for g in {g for _, g in roots}:
        want |= {(k, g): depth for k, (depth, _) in walk(pairs, [r for r in roots if r[1] == g], 5).items()}
    assert {(r.key, r.group_id): r.depth for r in got.collect()} == want and got.count() == len(want)


def test_manifest_with_a_cycle_and_a_missing_parent(spark):
    rows = [("A", None, 0), ("B", "A", 1), ("C", "B", 5), ("X", "Y", 1), ("Y", "X", 2), ("Z", "gone", 1)]
    df = spark.createDataFrame(rows, "pn STRING, parent STRING, level INT")
    got = {r.pn: (r.walk_level, r.root, r.level_ok) for r in manifest_walk(df, "pn", "parent", "level").collect()}
    assert got == {
        "A": (0, "A", True), "B": (1, "A", True), "C": (2, "A", False),
        "X": (None, None, False), "Y": (None, None, False), "Z": (None, None, False),
    }


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rows = [(f"p{i}", f"p{i - 1}" if i else None, i) for i in range(1000)] + [("p500", "q", 0), ("q", None, 0), ("c1", "c2", 1), ("c2", "c1", 1), ("c3", "c2", 1)]
    written, real = [], graph.save_table
    monkeypatch.setattr(graph, "save_table", lambda df, path: written.append(path) or real(df, path))
    df = spark.createDataFrame(rows, "`p.n` STRING, parent STRING, level INT")
    got = {(r[0], r.root): (r.walk_level, r.level_ok) for r in manifest_walk(df, "p.n", "parent", "level").collect()}
    assert sum("/up-" in p for p in written) <= 11
    assert all(got[f"p{i}", "p0"][0] == i for i in range(1000)) and all(got[f"p{i}", "q"][0] == i - 499 for i in range(500, 1000))
    assert got["c1", None] == got["c3", None] == (None, False) and len(got) == 1000 + 500 + 1 + 3


def test_a_level_moves_only_its_frontier(spark):
    """Above the edges and the visited nodes there is no exchange; those in the plan belong to what is reached."""
    state = workspace(spark, "t")
    pairs = [(str(i), str(j)) for i in range(50) for j in range(i, i + 5)]
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        traverse(edges_of(spark, pairs), roots_of(spark, [("0", "g"), ("1", "h")]), 2, state, by_group=True)
        for by_group, most in ((False, 1), (True, 2)):
            with graph.opened(spark, state, 2) as tables:
                plan = graph.next_level(tables, 2, ["n"], by_group)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") <= most and plan.count("Bucketed: true") == 3
            assert "Exchange hashpartitioning(known" not in plan and "Exchange hashpartitioning(bucket_key" not in plan


def test_edges_drop_missing_keys_and_repeated_links(spark):
    link = spark.createDataFrame([(1, 2), (1, 2), (None, 3)], "a INT, b INT")
    assert [tuple(r) for r in relationship_edges([Relation("s", "d", link, "a", "b", link=True)]).collect()] == [("s", "1", "d", "2")]
    assert relationship_edges([Relation("s", "d", link, "a", "b")]).count() == 2


def test_text_parts_of_a_hot_group_are_its_whole_text(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"))
    parts = ordered_text_parts(df, ["g"], "id", ["id"], "t", 100).collect()
    assert max(len(r.t.split(",")) for r in parts) <= 100
    hot = ",".join(r.t for r in sorted(parts, key=lambda r: r.part) if r.g == "hot")
    assert hot == ",".join(str(i) for i in range(0, 5000, 3))


def test_numbers_of_a_link_are_made_distinct_before_they_are_text(spark):
    link = spark.createDataFrame([(1, 2), (1, 2), (None, 2), (2, 1), (12, 1), (1, 21)], "a BIGINT, b INT")
    edges = relationship_edges([Relation("s", "d", link, "a", "b", link=True)])
    assert sorted((r.src_key, r.dst_key) for r in edges.collect()) == [("1", "2"), ("1", "21"), ("12", "1"), ("2", "1")]
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "Aggregate [a#" in grouped and "b#" in grouped.split("]")[0]  # by the numbers, not their texts
    same = relationship_edges([Relation("s", "d", link.selectExpr("a AS A", "CAST(b AS DOUBLE) AS b"), "a", "b", link=True)])
    assert same.count() == 4 and relationship_edges([Relation("s", "d", link, "a", "a", link=True)]).count() == 3
