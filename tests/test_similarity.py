"""Item CF (R1/R2), hot fill (U3) and ranking metrics (X2) on edge frames."""

import math

from pyspark.sql import functions as F

from recsmith.operators.similarity import (
    cooccurrence_pairs, hot_fill, hot_items, item_similarity, pair_accumulate, ranking_metrics, recommend)


def _log(spark, rows):
    return spark.createDataFrame([(u, i, float(t), t * 1_000_000) for u, i, t in rows],
                                 "user_id long, item_id long, time double, time_us long")


def test_single_click_user_makes_no_pair(spark):
    assert cooccurrence_pairs(_log(spark, [(1, 5, 0)])).count() == 0


def test_order_penalty_and_reference_formula(spark):
    # two users, same two items, reversed order
    log = _log(spark, [(1, 1, 0), (1, 2, 3600), (2, 2, 0), (2, 1, 3600)])
    acc = {(r.item, r.relate_item): r for r in pair_accumulate(cooccurrence_pairs(log)).collect()}
    # forward pair in user 1: no vectors -> node = deep = txt = 0.5
    base = 0.5 ** 2 * 0.5 * 0.5 * max(0.5, 0.9 ** 0) * max(0.5, 1 / (1 + 1.0)) / (math.log(1 + 2) * math.log(1 + 2))
    fwd, rev = int(base * 1e4), int(base * 0.8 * 1e4)
    assert acc[(1, 2)].sim_ticks == fwd + rev and acc[(1, 2)].cnt == 2
    assert acc[(1, 2)].min_dloc == 1 and acc[(1, 2)].min_dt == 1.0


def test_blocking_gives_identical_pairs(spark):
    rows = [(u, (u * 7 + j) % 13, j * 100) for u in range(4) for j in range(23)]
    log = _log(spark, rows)
    a = sorted(tuple(r) for r in pair_accumulate(cooccurrence_pairs(log, block=4096)).collect())
    b = sorted(tuple(r) for r in pair_accumulate(cooccurrence_pairs(log, block=5)).collect())
    assert a == b


def test_recommend_excludes_history_and_hot_fill_tops_up(spark):
    train = _log(spark, [(1, 1, 0), (1, 2, 10), (2, 1, 0), (2, 3, 10), (3, 2, 0), (3, 3, 5), (3, 4, 9)])
    sim = item_similarity(train)
    recs = recommend(train, sim)
    seen = {(r.user_id, r.item_id) for r in train.collect()}
    assert all((r.user_id, r.item_id) not in seen for r in recs.collect())
    hot = hot_items(train, k=3)
    filled = hot_fill(recs, hot, k=3).collect()
    users = {r.user_id for r in recs.collect()}
    assert {r.user_id for r in filled} == users
    assert all(sum(1 for r in filled if r.user_id == u) <= 3 for u in users)
    assert len({(r.user_id, r.item_id) for r in filled}) == len(filled)


def test_hot_fill_keep_rule(spark):
    recs = spark.createDataFrame([(1, 7, 0.5)], "user_id long, item_id long, score double")
    hot = spark.createDataFrame([(7, 1), (8, 2)], "item_id long, hot_rank int")
    hi = {r.item_id: r.score for r in hot_fill(recs, hot, k=5).collect()}
    lo = {r.item_id: r.score for r in hot_fill(recs, hot, k=5, keep="lowest").collect()}
    assert hi == {7: 0.5, 8: -2.0} and lo == {7: -1.0, 8: -2.0}


def test_short_list_is_miss_and_unseen_item_popularity_zero(spark):
    train = _log(spark, [(1, 1, 0), (2, 1, 0), (2, 2, 1)])
    preds = spark.createDataFrame([(1, 5, 1), (2, 9, 1)], "user_id long, item_id long, rank int")
    answers = spark.createDataFrame([(1, 5), (2, 42), (3, 1)], "user_id long, item_id long")
    m = ranking_metrics(preds, answers, train, k=50).collect()[0]
    # answered users with predictions: 1 (hit at rank 0), 2 (miss); user 3 skipped
    assert m.hr_full == 0.5 and m.ndcg_full == 0.5
    # degrees of all answers: user1 item5 -> 0, user2 item42 -> 0, user3 item1 -> 2; upper median = 0
    assert m.hr_half == 0.5


def test_user_item_pairs_blocked_equals_naive(spark):
    from recsmith.operators.similarity import user_item_pairs
    rows = [(u, (u * 5 + j) % 17, j) for u in range(5) for j in range(40)]
    log = _log(spark, rows)
    got = sorted(tuple(r) for r in user_item_pairs(log, block=7).collect())
    want = sorted({(a, b) for u in range(5) for (_, a, _) in [r for r in rows if r[0] == u]
                   for (_, b, _) in [r for r in rows if r[0] == u] if a < b})
    assert got == want


def test_candidates_are_summed_before_they_move(spark):
    """No join on the user meets rows of (history item, related item)."""
    from recsmith.operators.similarity import recommend
    log = spark.range(400).selectExpr("id div 10 user_id", "id % 10 + (id div 200) * 5 item_id", "cast(id as double) time", "id time_us")
    sim = (spark.range(225).selectExpr("id div 15 item", "id % 15 relate_item").where("item <> relate_item")
           .selectExpr("*", "0.5D sim", "1L cnt", "1D weighted", "0.1D min_dt", "1L min_dloc", "0.5D node", "0.5D node_sum", "0.5D deep", "0.5D deep_sum"))
    out = recommend(log, sim)
    rows = out.collect()
    assert len(rows) == 40 * 5
    assert all((r.item_id >= 10) == (r.user_id < 20) or r.item_id < 5 for r in rows)
    assert {r.item_id for r in rows if r.user_id == 0} == set(range(10, 15)) and {r.item_id for r in rows if r.user_id == 39} == set(range(5))
    assert all(r.f_cnt == 10 for r in rows)
    assert "LeftAnti" not in out._jdf.queryExecution().toString()


def _spread_log(spark):
    """40 users with 12 to 30 of 200 items, some twice, one item of all users, null users and items."""
    import random
    rnd = random.Random(4)
    rows = [(u, i, t * 977) for u in range(40) for t, i in enumerate([7] + [rnd.randrange(200) for _ in range(rnd.randrange(11, 30))])]
    return _log(spark, rows + [(None, 3, 5), (None, 4, 9), (3, None, 1)]).where("time is not null")


def test_rounds_and_parts_of_items_change_nothing(spark):
    from pyspark.sql import Window
    log = _spread_log(spark)
    vec = spark.range(0, 200, 3).selectExpr("id item_id", "transform(sequence(1, 64), x -> cast(sin(x * (id + 1)) as float)) vec")
    acc = pair_accumulate(cooccurrence_pairs(log, vec))
    want = {(r.item, r.relate_item): (r.cnt, r.weighted_ticks / 1e4, r.min_dt, r.min_dloc, r.node, r.deep) for r in
            acc.withColumn("_r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("sim_ticks"), "relate_item"))).where("_r <= 20").collect()}
    assert len(want) > 3000 and max(v[0] for v in want.values()) > 1
    plain = sorted(tuple(r) for r in item_similarity(log, vec, top_k=20).collect())
    assert {r[:2]: (r[3], *r[4:8], r[9]) for r in plain} == want
    for more in ({"round_pairs": 4000}, {"item_pairs": 300}, {"round_pairs": 4000, "item_pairs": 300, "block": 5}):
        assert sorted(tuple(r) for r in item_similarity(log, vec, top_k=20, **more).collect()) == plain, more


def test_occurrences_move_once_and_a_round_at_a_time(spark, monkeypatch):
    """Item pairs that hardly repeat are moved to their item only, not by pair
    and then again by item; a round has its share of them."""
    import re

    from recsmith.operators import similarity as S
    log = _spread_log(spark)
    monkeypatch.setattr(S, "TASK_PAIRS", 5000, raising=False)
    plan = item_similarity(log, top_k=20)._jdf.queryExecution().toString()
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)|RepartitionByExpression \[([^\]]*)\]", plan)
    assert moved and not any("relate_item" in a + b for a, b in moved)
    tables = []
    plain = S.as_table
    monkeypatch.setattr(S, "as_table", lambda df, tidy=False: (tables.append((tidy, out := plain(df, tidy))), out)[1])
    item_similarity(log, top_k=10**6, round_pairs=4000)
    rounds = [t.agg(F.sum("cnt")).first()[0] for tidy, t in tables if tidy and "cnt" in t.columns]
    total = cooccurrence_pairs(log).count()
    assert sum(rounds) == total and len(rounds) > 4 and max(rounds) < total / 2


def _packed(monkeypatch):
    from recsmith.operators import cell_sums
    from recsmith.operators import similarity as S
    monkeypatch.setattr(S, "TASK_PAIRS", 5000)
    for name, n in (("BUNDLE", 64), ("CHUNK", 500)):
        monkeypatch.setattr(cell_sums, name, n)
    return S


def test_packed_cells_equal_plain_sums(spark, monkeypatch):
    """Null times, rows that come twice, ids beyond 32 bits, vectors that come
    twice, are missing or hold nulls, users of several blocks."""
    log = _spread_log(spark)
    odd = log.where("item_id % 5 < 2").unionByName(log.where("user_id < 4"))
    odd = odd.selectExpr("user_id", "if(item_id % 2 = 0, item_id, -item_id * 3000000001) item_id", "if(item_id % 7 = 3, null, time) time", "time_us")
    vec = spark.range(0, 200, 3).selectExpr("id item_id", "if(id = 9, null, transform(sequence(1, 70), x -> if(id = 6 and x = 30, null, cast(sin(x * (id + 1)) as float)))) vec")
    vec = vec.unionByName(vec.where("item_id in (0, 12, 30)"))
    for kind in (odd, odd.selectExpr("user_id", "cast(item_id as string) item_id", "time", "time_us")):
        if dict(kind.dtypes)["item_id"] == "string":
            vec = vec.selectExpr("cast(item_id as string) item_id", "vec")
        plain = item_similarity(kind, vec, top_k=7)
        want = sorted(map(str, plain.collect()))
        with monkeypatch.context() as m:
            _packed(m)
            got = item_similarity(kind, vec, top_k=7, block=6, round_pairs=9000, item_pairs=400)
            assert got.dtypes == plain.dtypes and sorted(map(str, got.collect())) == want and len(want) > 300


def test_no_row_for_a_pair_and_rounds_do_not_grow_with_the_table(spark, monkeypatch):
    import re
    S = _packed(monkeypatch)
    log = _spread_log(spark)
    plan = item_similarity(log, top_k=20)._jdf.queryExecution().toString()
    assert not re.search(r"explode\(rows", plan) and "MapInArrow" in plan
    monkeypatch.setattr(S, "ROUND_PAIRS", 4000)
    monkeypatch.setattr(S, "ROUND_MET", 6, raising=False)
    plain, numbers = S.as_table, []
    for copies in (1, 3):
        tables = []
        monkeypatch.setattr(S, "as_table", lambda df, tidy=False: (tables.append((tidy, out := plain(df, tidy))), out)[1])
        many = log.crossJoin(spark.range(copies)).selectExpr("user_id + id * 1000 user_id", "item_id + id * 1000 item_id", "time", "time_us")
        rows = item_similarity(many, top_k=10**6).count()
        rounds = [t.agg(F.sum("cnt")).first()[0] for tidy, t in tables if tidy and "cnt" in t.columns]
        assert sum(rounds) == cooccurrence_pairs(many).count()
        numbers.append((len(rounds), rows / copies))
    assert numbers[0] == numbers[1] and numbers[0][0] > 2
