"""Chunked sequences against the whole-sequence operators."""

import random

import pytest
from pyspark.sql import functions as F

from recsmith.functions.arrays import shifted_targets, split_last
from recsmith.operators import chunked as C
from recsmith.operators import logs as L
from recsmith.operators.encode import range_numbered


@pytest.fixture(scope="module")
def log(spark):
    rnd = random.Random(6)
    rows = [(u, rnd.randint(0, 30), 100 + 7 * k) for u, n in [(1, 1), (2, 2), (3, 8), (4, 9), (5, 40), (None, 17)] for k in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "user_id long, item_id long, time_us long").repartition(5)


def _joined(rows, key, column):
    """{key: concatenation of the chunks' arrays}"""
    out = {}
    for r in sorted(rows, key=lambda r: (str(r[key]), r.chunk)):
        out.setdefault(r[key], []).extend(r[column])
    return out


@pytest.mark.parametrize("size,threshold", [(1, 10**6), (8, 10**6), (8, 5), (1024, 5)])
def test_chunks_make_the_whole_arrays(log, size, threshold):
    kw = {"size": size, "threshold": threshold}
    whole = {r.user_id: r for r in L.user_sequences(log).collect()}
    rows = C.sequence_chunks(log, **kw).collect()
    assert _joined(rows, "user_id", "items") == {u: r["items"] for u, r in whole.items()}
    assert _joined(rows, "user_id", "times") == {u: r.times for u, r in whole.items()}
    assert all(len(r["items"]) <= size and r.offset == r.chunk * size and r.n == whole[r.user_id].n for r in rows)
    for distinct in (False, True):
        sets = {r.user_id: r["items"] for r in L.user_click_set(log, distinct=distinct).collect()}
        assert _joined(C.click_set_chunks(log, distinct=distinct, **kw).collect(), "user_id", "items") == sets
    x, y = shifted_targets("items")
    pairs = {r.user_id: (r.x, r.y) for r in L.user_sequences(log).select("user_id", x.alias("x"), y.alias("y")).collect()}
    rows = C.shifted_target_chunks(log, **kw).collect()
    assert _joined(rows, "user_id", "inputs") == {u: p[0] for u, p in pairs.items()}
    assert _joined(rows, "user_id", "targets") == {u: p[1] for u, p in pairs.items()}
    h, last = split_last("items")
    want = {r.user_id: (r.h, r.l) for r in L.user_sequences(log).select("user_id", h.alias("h"), last.alias("l")).collect()}
    rows = C.next_item_chunks(log, **kw).collect()
    assert _joined(rows, "user_id", "history") == {u: w[0] for u, w in want.items()}
    assert {r.user_id: r.label for r in rows if r["last"]} == {u: w[1] for u, w in want.items()}


@pytest.mark.parametrize("size,n", [(4, 3), (4, 11), (1, 5), (64, 20)])
def test_halos_give_the_windows(log, size, n):
    got = {(r.user_id, r.loc): (r.item_id, r.hist) for r in C.window_histories(log, "item_id", n, size=size, threshold=5).collect()}
    seq = {r.user_id: r["items"] for r in L.user_sequences(log).collect()}
    assert got == {(u, k): (v, s[max(0, k - n):k]) for u, s in seq.items() for k, v in enumerate(s)}


@pytest.mark.parametrize("size", [3, 100])
def test_prefixes_and_histories_in_parts(spark, log, size):
    seq = {r.user_id: r["items"] for r in L.user_sequences(log).collect()}
    got = {}
    for r in sorted(C.causal_prefix_parts(log, "item_id", size=size, threshold=5).collect(), key=lambda r: r.part):
        assert 0 < len(r.prefix) <= size
        got.setdefault((r.user_id, r.loc), []).extend(r.prefix)
    assert got == {(u, k): s[:k + 1] for u, s in seq.items() for k in range(len(s))}
    rows = spark.createDataFrame([(1, "a"), (5, "b"), (None, "c"), (99, "d"), (5, "e")], "user_id long, tag string")
    found = {}
    for r in sorted(C.history_parts(rows, log, size=size).collect(), key=lambda r: r.part or 0):
        found.setdefault((r.user_id, r.tag), []).extend(r["items"] or [])
    assert found == {(r.user_id, r.tag): seq.get(r.user_id, []) for r in rows.collect()}


def test_one_user_with_a_third_of_all_rows_spans_many_tasks(spark):
    log = spark.range(60_000).selectExpr("if(id < 20000, 0L, id % 4000 + 1) user_id", "id % 97 item_id", "id time_us")
    rows = C.sequence_chunks(log, size=256, threshold=5000)
    hot = rows.where("user_id = 0").select("chunk", F.size("items").alias("k"), F.col("items")[0].alias("i"), F.col("times")[0].alias("t")).collect()
    assert len(hot) == 79 and sum(r.k for r in hot) == 20_000 and all(r.t == r.chunk * 256 and r.i == r.t % 97 for r in hot)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # 20,000 rows would fit a task
    spark.conf.set("spark.sql.shuffle.partitions", "8")  # the session's 4 could never be more than 4
    try:
        parts = range_numbered(log.where("user_id = 0"), [F.col("user_id").asc(), F.col("time_us").asc()]).groupBy("_pid").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(parts) > 4 and max(r["count"] for r in parts) < 20_000 / 2
    spread = rows.where("user_id = 0").repartition(8, "user_id", "chunk").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 8
