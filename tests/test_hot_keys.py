"""Hot keys: the split path (range partition + offsets + equi-joins) must
give exactly what the plain per-key window gives."""

import random

import pytest
from pyspark.sql import functions as F

from recsmith.operators import logs as L
from recsmith.operators.eda import exact_percentiles
from recsmith.operators.encode import dense_ids
from recsmith.operators.sequence import positions, split_hot, with_history, with_next
from recsmith.operators.similarity import cooccurrence_pairs, pair_accumulate


def _log(spark):
    rnd = random.Random(5)
    rows = []
    for u, n in [(1, 400), (2, 7), (3, 1), (4, 60)]:
        for j in range(n):
            rows.append((u, rnd.randint(0, 30), rnd.randint(0, 50) * 1_000_000))
    df = spark.createDataFrame(rows, "user_id long, item_id long, time_us long")
    return df.dropDuplicates().withColumn("time", F.col("time_us") / 1e6)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_positions_hot_equals_window(spark):
    df = _log(spark)
    for desc in (False, True):
        a = positions(df, "user_id", ["time_us", "item_id"], desc=desc)
        b = positions(df, "user_id", ["time_us", "item_id"], desc=desc, threshold=5)
        assert _rows(a) == _rows(b)


def test_history_and_next_hot_equal_window(spark):
    df = _log(spark).withColumn("code", F.col("item_id").cast("int"))
    a = with_history(df, "user_id", ["time_us", "item_id"], {"code": "h"}, 20, last_flag="last")
    b = with_history(df, "user_id", ["time_us", "item_id"], {"code": "h"}, 20, threshold=5, last_flag="last")
    assert _rows(a) == _rows(b)
    a = with_next(df, "user_id", ["time_us", "item_id"], {"item_id": "nx", "time": "nt"}, loc="pos")
    b = with_next(df, "user_id", ["time_us", "item_id"], {"item_id": "nx", "time": "nt"}, loc="pos", threshold=5)
    assert _rows(a) == _rows(b)


def test_logs_operators_hot_equal_window(spark):
    df = _log(spark)
    assert _rows(L.leave_two_out_split(df)) == _rows(L.leave_two_out_split(df, hot_threshold=3))
    assert _rows(L.time_gap(df)) == _rows(L.time_gap(df, hot_threshold=3))
    code = df.withColumn("c", F.col("item_id").cast("int"))
    a = L.click_history(code, {"c": "h"}, n=20, with_split=True)
    b = L.click_history(code, {"c": "h"}, n=20, with_split=True, hot_threshold=3)
    assert _rows(a) == _rows(b)


def test_pairs_with_hot_user_and_blocks(spark):
    from recsmith.operators.sequence import HotSet, attach_hot, hot_keys
    df = _log(spark)
    a = _rows(pair_accumulate(cooccurrence_pairs(df)))
    keys, n = hot_keys(df, "user_id", 5)
    hot_df = attach_hot(df.select("*"), HotSet(keys, n))
    b = _rows(pair_accumulate(cooccurrence_pairs(hot_df, block=37)))
    assert n > 0 and a == b


def test_recall_pipeline_with_shared_hot_set(spark):
    from recsmith.operators.graph import build_edges
    from recsmith.operators.similarity import hot_fill, hot_items, item_similarity, recommend
    from recsmith.plans.recall import recall_split
    log = _log(spark)

    def run(threshold):
        train, validate, _ = recall_split(log, hot_threshold=threshold)
        recs = recommend(train, item_similarity(train), users=validate)
        return (_rows(hot_fill(recs, hot_items(train))), _rows(build_edges(train)),
                _rows(L.time_gap(train)))

    assert run(1_000_000) == run(5)


def _large(spark, users):
    """300,000 rows over `users` users, with a payload that does not sort."""
    n = 300_000
    return spark.range(n).select(
        (F.col("id") % users).alias("user_id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("item_id"),
        (F.col("id") * 1_000_000).alias("time_us"), F.concat(F.lit("p"), F.xxhash64("id", F.lit(7)).cast("string")).alias("payload"))


def _differ(a, b):
    """Whether two frames differ as bags of rows, by count and hash sum."""
    def mark(df):
        row = F.xxhash64(*[F.col(c) for c in sorted(b.columns)]).cast("decimal(38,0)")
        return df.agg(F.count("*"), F.sum(row), F.sum(F.hash(*[F.col(c) for c in sorted(b.columns)]).cast("bigint"))).first()
    return int(mark(a) != mark(b))


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("users", [1, 60])
def test_large_hot_users_equal_window(spark, users, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = _large(spark, users)
        order = ["time_us", "item_id"]
        assert _differ(positions(df, "user_id", order, threshold=1000), positions(df, "user_id", order)) == 0
        assert _differ(L.leave_two_out_split(df, hot_threshold=1000), L.leave_two_out_split(df)) == 0
        assert _differ(L.leave_one_out_split(df, hot_threshold=1000), L.leave_one_out_split(df)) == 0
        a = with_next(df, "user_id", order, {"item_id": "nx"}, threshold=1000)
        assert _differ(a, with_next(df, "user_id", order, {"item_id": "nx"})) == 0
        a = with_history(df, "user_id", order, {"item_id": "h"}, 3, threshold=1000, last_flag="last")
        assert _differ(a, with_history(df, "user_id", order, {"item_id": "h"}, 3, last_flag="last")) == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_dense_ids_and_percentiles_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        n = 200_000
        codes = dense_ids(spark.range(n).select((F.col("id") * 3).alias("v")), "v", start=1)
        bad = codes.where(F.col("id") != F.col("v") / 3 + 1).count()
        assert codes.count() == n and bad == 0
        got = exact_percentiles(spark.range(n), "id", [0.25, 0.5]).collect()
        assert sorted((r.prob, r.value) for r in got) == [(0.25, (n - 1) / 4), (0.5, (n - 1) / 2)]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_null_user_is_hot_and_split(spark):
    rows = [(None, j % 7, j) for j in range(500)] + [(1, j, j) for j in range(5)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, time_us long")
    normal, hot = split_hot(df, "user_id", 100)
    assert hot.count() == 500 and normal.count() == 5
    order = ["time_us", "item_id"]
    assert _differ(positions(df, "user_id", order, threshold=100), positions(df, "user_id", order)) == 0
    a = with_next(df, "user_id", order, {"item_id": "nx"}, threshold=100)
    assert _differ(a, with_next(df, "user_id", order, {"item_id": "nx"})) == 0


def test_null_items_do_not_end_a_history(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, None, 2), (1, 11, 3), (1, 12, 4)], "user_id long, item_id long, time_us long")
    for threshold in (1, 1000):
        one = L.leave_one_out_split(df, hot_threshold=threshold)
        assert [r.time_us for r in one.where("split = 'test'").collect()] == [4]
        hist = L.click_history(df, {"item_id": "h"}, n=2, pad=False, with_split=True, hot_threshold=threshold)
        assert [r.time_us for r in hist.where("split = 'test'").collect()] == [4]
        assert {r.time_us: list(r.h) for r in hist.collect()} == {1: [], 2: [10], 3: [10], 4: [11]}
