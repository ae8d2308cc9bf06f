"""Alias tables by prefix sums, running values of hot keys, walks and G4 on hubs."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from recsmith.operators import graph as G
from recsmith.operators.alias import TICKS, alias_draw, alias_table, weight_ticks
from recsmith.operators.sequence import join_per_key, running


def _groups(rnd):
    shapes = {1: [5], 2: [1, 1, 1, 1], 3: [1, 2, 3, 4, 5], 4: [100, 1, 1, 1], 5: [1] * 9 + [91], 6: [3, 3, 6, 6, 2, 4], None: [7, 1, 2],
              7: [10 ** 12, 1, 10 ** 12, 3]}
    shapes |= {k: [rnd.randint(1, 40) for _ in range(rnd.randint(1, 30))] for k in range(10, 40)}
    return shapes


@pytest.mark.parametrize("threshold", [1_000_000, 4])
def test_every_choice_gets_its_exact_share(spark, threshold):
    """Cuts and aliases add up to n * weight; with hot groups over many tasks too."""
    shapes = _groups(random.Random(1))
    rows = [(g, c * 3, w) for g, ws in shapes.items() for c, w in enumerate(ws)] + [(8, 1, 0), (8, 2, 5)]
    df = spark.createDataFrame(rows, "g long, c long, w long").repartition(5)
    got = alias_table(df, "g", "c", "w", threshold).collect()
    share, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        assert 0 <= r.cut <= r.size
        share[r.g, r.c] += r.cut
        share[r.g, r.alias] += r.size - r.cut
        slots[r.g].append(r.slot)
    for g, c, w in rows:
        if w:
            n = len(slots[g])
            assert share[g, c] == n * w, (g, c)
    assert len(got) == sum(w > 0 for _, _, w in rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_draws_follow_the_table(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 20, 3), (2, 30, 5)], "g long, c long, w long")
    table = alias_table(df, "g", "c", "w")
    n = 4000
    draws = spark.range(n).selectExpr("id d", "1L g", f"(id + 0.5) / {n} _u", f"((id * 7919) % {n} + 0.5) / {n} _v")
    got = collections.Counter(r.c for r in alias_draw(table, draws, "g", "c").collect())
    assert abs(got[10] / n - 0.25) < 0.02 and got[10] + got[20] == n
    other = spark.createDataFrame([(0, 2, 0.99999999999999999, 0.5), (1, 3, 0.1, 0.1), (2, None, 0.1, 0.1)], "d long, g long, _u double, _v double")
    assert [(r.d, r.c) for r in alias_draw(table, other, "g", "c").collect()] == [(0, 30)]


def test_float_weights_become_ticks(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (1, 2, 1.0), (1, 3, 1e-30), (1, 4, 0.0), (1, 5, None), (1, 6, float("nan")), (2, 1, 1e300)],
                               "g long, c long, w double")
    got = {(r.g, r.c): r.ticks for r in weight_ticks(df, "g", "w").collect()}
    assert got == {(1, 1): TICKS // 2, (1, 2): TICKS, (1, 3): 1, (2, 1): TICKS}


@pytest.mark.parametrize("threshold", [1_000_000, 10])
def test_running_and_join_per_key(spark, threshold):
    rnd = random.Random(2)
    rows = [(rnd.choice([1, 1, 1, 2, None]), k, rnd.randint(0, 9), rnd.choice([None, None, k])) for k in range(300)]
    df = spark.createDataFrame(rows, "k long, o long, v long, l long").repartition(7)
    got = {r.o: (r.s, r.z) for r in running(df, "k", ["o"], {"v": "s"}, {"l": "z"}, threshold).collect()}
    for key in (1, 2, None):
        total, last = 0, None
        for k, o, v, seen in rows:
            if k == key:
                total, last = total + v, last if seen is None else seen
                assert got[o] == (total, last)
    side = spark.createDataFrame([(1, "a"), (None, "n")], "k long, name string")
    joined = {r.o: r.name for r in join_per_key(df, side, "k", "left", threshold).collect()}
    assert joined == {o: {1: "a", 2: None, None: "n"}[k] for k, o, _, _ in rows}
    assert join_per_key(df, side, "k", "inner", threshold).count() == sum(k != 2 for k, *_ in rows)


def _star(spark, leaves):
    """A hub with every edge at it, and a ring over the leaves beside it."""
    hub = spark.range(1, leaves + 1).selectExpr("0L src", "id dst", "1.0D + (id % 3) weight")
    back = spark.range(1, leaves + 1).selectExpr("id src", "0L dst", "2.0D weight")
    ring = spark.range(1, leaves + 1).selectExpr("id src", f"id % {leaves} + 1 dst", "1.0D weight")
    return hub.union(back).union(ring)


def test_walks_from_a_hub_are_the_same_over_many_tasks(spark):
    graph = _star(spark, 60)
    for walk in (G.uniform_walks, G.biased_walks):
        kw = {"walk_length": 5, "num_walks": 3, "direction": True}
        plain = sorted(map(tuple, walk(graph, **kw).collect()))
        hot = sorted(map(tuple, walk(graph, **kw, threshold=20).collect()))
        assert plain == hot and len({(a, b) for a, b, _, _ in plain}) == 61 * 3
    tries = sorted(map(tuple, G.biased_walks(graph, walk_length=5, num_walks=3, attempts=1).collect()))
    assert tries == sorted(map(tuple, G.biased_walks(graph, walk_length=5, num_walks=3, attempts=30).collect()))


def test_second_order_probabilities_in_slices(spark):
    graph = _star(spark, 40)
    plain = {(r.t, r.v, r.x): r.prob for r in G.transition_probs(graph)[1].collect()}
    first, second = G.transition_probs(graph, slice_edges=7, threshold=10)
    sliced = {(r.t, r.v, r.x): r.prob for r in second.collect()}
    assert plain.keys() == sliced.keys() and all(abs(plain[k] - sliced[k]) < 1e-12 for k in plain)
    sums = second.groupBy("t", "v").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)
    assert all(abs(r.s - 1) < 1e-9 for r in first.groupBy("src").agg(F.sum("prob").alias("s")).collect())


def test_no_task_of_a_walk_step_holds_the_hub(spark):
    """Walkers that all stand at the hub: the join on (node, index) deals them out."""
    graph = _star(spark, 4000).where("src = 0 or dst = 0")
    hop = G.numbered_edges(graph, True, threshold=500).select(F.col("src").alias("cur"), "_k")
    walkers = spark.range(40_000).selectExpr("0L cur", "id % 4000 _k")
    sizes = [r.n for r in walkers.repartition(8, "cur", "_k").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sorted(sizes)[4]
    assert walkers.join(hop, ["cur", "_k"]).count() == 40_000
    placed = G.numbered_edges(graph, True, threshold=500).where("src = 0").collect()
    assert [r._k for r in sorted(placed, key=lambda r: r.dst)] == list(range(4000)) and {r.deg for r in placed} == {4000}


def test_dead_ends_and_weights(spark):
    graph = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1e-12), (2, 4, 1.0), (5, 5, 0.0)], "src long, dst long, weight double")
    rows = G.biased_walks(graph, walk_length=4, num_walks=50).collect()
    paths = collections.defaultdict(dict)
    for r in rows:
        paths[r.start, r.walk][r.step] = r.node
    assert len(paths) == 5 * 50
    assert all(p == {0: 5} for (s, _), p in paths.items() if s == 5)  # an edge without weight is never taken
    assert all(p[:2] == [1, 2] and p[2] in (3, 4) and len(p) == 3 for p in ([v for _, v in sorted(p.items())] for (s, _), p in paths.items() if s == 1))
