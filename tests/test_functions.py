"""Scalar expressions: truncation parity, hashing, decays (F1..F14)."""

import math
import random

from pyspark.sql import functions as F

from recsmith.functions import columns as C
from recsmith.functions.arrays import pad_zero, shifted_targets, split_last


def myround(x, thres=4):
    return int(x * 10 ** thres) / 10 ** thres


def test_tick_sums_equal_running_truncation(spark):
    rnd = random.Random(7)
    seqs = [[rnd.random() * rnd.choice([0.01, 1, 30]) for _ in range(rnd.randint(1, 30))] for _ in range(300)]
    rows = [(i, j, x) for i, s in enumerate(seqs) for j, x in enumerate(s)]
    df = spark.createDataFrame(rows, "s int, j int, x double")
    got = {r["s"]: r["t"] for r in df.groupBy("s").agg(F.sum(C.trunc_ticks("x")).alias("t")).collect()}
    for i, s in enumerate(seqs):
        acc = 0.0
        for x in s:
            acc = myround(acc + x)
        assert round(acc * 10000) == got[i]


def test_trunc_toward_zero(spark):
    df = spark.createDataFrame([(1.23456,), (-1.23456,), (0.99999,)], "x double")
    assert [r[0] for r in df.select(C.trunc4("x")).collect()] == [1.2345, -1.2345, 0.9999]


def test_decays_and_damps(spark):
    r = spark.range(1).select(
        C.loc_decay(F.lit(0)).alias("a"), C.loc_decay(F.lit(20)).alias("b"),
        C.time_decay(F.lit(0.0)).alias("c"), C.time_decay(F.lit(5.0)).alias("d"),
        C.popularity_damp(F.lit(1)).alias("e"), C.popularity_damp(F.lit(100)).alias("f"),
        C.order_penalty(F.lit(3), F.lit(1)).alias("g"), C.order_penalty(F.lit(1), F.lit(3)).alias("h"),
        C.ndcg_gain(F.lit(0)).alias("i"), C.sigmoid(F.lit(0.0)).alias("j"),
        C.edge_weight(F.lit(100), F.lit(1), F.lit(0.0)).alias("k"),
        C.edge_weight(F.lit(1), F.lit(1), F.lit(1.0), reverse=True).alias("l")).collect()[0]
    assert r.a == 1.0 and r.b == 0.5 and r.c == 1.0 and r.d == 0.5
    assert r.e == 0.5 and r.f == 0.2 and r.g == 0.8 and r.h == 1.0
    assert r.i == 1.0 and r.j == 0.5
    assert math.isclose(r.k, max(3, math.log(101)))
    assert math.isclose(r.l, 3 * 0.8 / 2)


def test_hash_is_deterministic_and_matches_md5(spark):
    import hashlib
    v = spark.range(1).select(C.hash32(F.lit(12), F.lit("a"), F.lit(3)).alias("h")).collect()[0].h
    assert v == int(hashlib.md5(b"12|a|3").hexdigest()[:8], 16)


def test_hash_bucket_mask_zero(spark):
    df = spark.createDataFrame([("0",), ("a",), ("b",)], "v string")
    out = [r[0] for r in df.select(C.hash_bucket("v", 10, mask_zero=True)).collect()]
    assert out[0] == 0 and all(1 <= x <= 9 for x in out[1:])


def test_affinity_missing_vector_is_half(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], None), ([1.0, 0.0], [-1.0, 0.0])],
                               "a array<double>, b array<double>")
    assert [r[0] for r in df.select(C.affinity("a", "b")).collect()] == [1.0, 0.5, 0.0]


def test_pad_split_shift(spark):
    df = spark.createDataFrame([([1, 2],), ([],), ([1, 2, 3, 4],)], "a array<int>")
    padded = [r[0] for r in df.select(pad_zero("a", 3)).collect()]
    assert padded == [[1, 2, 0], [0, 0, 0], [1, 2, 3, 4]]
    h, last = split_last("a")
    x, y = shifted_targets("a")
    rows = df.select(h.alias("h"), last.alias("l"), x.alias("x"), y.alias("y")).collect()
    assert rows[0].h == [1] and rows[0].l == 2 and rows[2].x == [1, 2, 3] and rows[2].y == [2, 3, 4]
    assert rows[1].h == [] and rows[1].l is None
