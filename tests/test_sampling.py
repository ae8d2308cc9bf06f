"""Negative sampling, stratified sampling, weighted choice (N1..N4, H6)."""

from pyspark.sql import functions as F

from recsmith.operators.sampling import negative_sample, stratified_sample, weighted_choice


def _setup(spark, hist_rows, pool_items):
    rows = spark.createDataFrame([(u, i, t, 100 + i) for u, i, t in hist_rows],
                                 "user_id long, item_id long, time_us long, category long")
    pool = spark.createDataFrame([(i, 100 + i) for i in pool_items], "item_id long, category long")
    return rows, pool


def test_k_negatives_never_in_history_with_category(spark):
    hist = [(1, i, i) for i in range(5)] + [(2, i, i) for i in range(3, 9)]
    rows, pool = _setup(spark, hist, range(40))
    out = negative_sample(rows, pool, rows.select("user_id", "item_id"), k=4)
    pos = out.where(F.col("label") == 1).count()
    neg = out.where(F.col("label") == 0).collect()
    assert pos == len(hist) and len(neg) == 4 * len(hist)
    seen = {(u, i) for u, i, _ in hist}
    assert all((r.user_id, r.item_id) not in seen for r in neg)
    assert all(r.category == 100 + r.item_id for r in neg)


def test_nearly_exhausted_pool_uses_exact_branch(spark):
    # user 1 clicked 99 of 100 items: rejection draws almost always fail,
    # the gap branch must still deliver 4 negatives, all the one free item
    hist = [(1, i, i) for i in range(100) if i != 57]
    rows, pool = _setup(spark, hist[:3], range(100))
    history = spark.createDataFrame([(u, i) for u, i, _ in hist], "user_id long, item_id long")
    neg = negative_sample(rows, pool, history, k=4).where(F.col("label") == 0).collect()
    assert len(neg) == 12 and {r.item_id for r in neg} == {57}


def test_exhausted_pool_gives_fewer_not_error(spark):
    hist = [(1, i, i) for i in range(10)]
    rows, pool = _setup(spark, hist, range(10))
    out = negative_sample(rows, pool, rows.select("user_id", "item_id"), k=4)
    assert out.where(F.col("label") == 0).count() == 0 and out.count() == 10


def test_negatives_are_deterministic(spark):
    hist = [(1, i, i) for i in range(5)]
    rows, pool = _setup(spark, hist, range(30))
    a = sorted(tuple(r) for r in negative_sample(rows, pool, rows.select("user_id", "item_id")).collect())
    b = sorted(tuple(r) for r in negative_sample(rows, pool, rows.select("user_id", "item_id")).collect())
    assert a == b


def _plain_complement(taken, n):
    return [i for i in range(n) if i not in taken]


def test_rank_directory_lists_every_complement(spark):
    """Every rank of every user, for histories of all shapes, null user too."""
    import random
    from recsmith.operators.sampling import item_of_rank, rank_directory
    rnd = random.Random(3)
    n = 60
    taken = {1: set(), 2: set(range(n)), 3: {0}, 4: {n - 1}, 5: set(range(n)) - {57}, 6: set(range(10, 50)), None: set(range(0, n, 2))}
    taken |= {u: set(rnd.sample(range(n), rnd.randint(1, n))) for u in range(10, 30)}
    users = spark.createDataFrame([(u,) for u in taken], "_u long")
    rows = spark.createDataFrame([(u, i) for u, t in taken.items() for i in t], "_h_user long, _pidx long")
    for bucket in (1, 4, 1024):
        sizes, directory = rank_directory(users, rows, n, bucket)
        draws = sizes.selectExpr("_u", "explode(sequence(0L, _C - 1)) _r")
        got = {}
        for r in item_of_rank(draws, directory, bucket).collect():
            got.setdefault(r._u, {})[r._r] = r._pidx
        want = {u: dict(enumerate(_plain_complement(t, n))) for u, t in taken.items() if len(t) < n}
        assert got == want


def test_null_keys_get_negatives(spark):
    rows = spark.createDataFrame([(None, 2, 1, 102), (2, None, 1, 1), (None, None, 5, 1), (2, 3, 1, 103)],
                                 "user_id long, item_id long, time_us long, category long")
    pool = spark.createDataFrame([(i, 100 + i) for i in range(6)] + [(None, 7)], "item_id long, category long")
    out = negative_sample(rows, pool, rows.select("user_id", "item_id"), k=4).where("label = 0").collect()
    assert len(out) == 16 and all(r.category == 100 + r.item_id for r in out)
    assert all(r.item_id != 2 for r in out if r.user_id is None) and all(r.item_id != 3 for r in out if r.user_id == 2)
    assert sorted(str(r.time_us) + str(r.user_id) for r in out) == sorted(4 * ["1None", "12", "5None", "12"])


def test_repeated_rows_have_draws_of_their_own(spark):
    rows = spark.createDataFrame([(1, 2, 3, 4, f"row {k}") for k in range(6)] + [(9, 9, 9, 9, "once")],
                                 "user_id long, item_id long, time_us long, category long, context string")
    pool = spark.createDataFrame([(i, 100 + i) for i in range(1000)], "item_id long, category long")
    out = negative_sample(rows, pool, rows.select("user_id", "item_id"), k=4).where("label = 0").collect()
    by = {}
    for r in out:
        by.setdefault(r.context, []).append(r.item_id)
    assert len(by) == 7 and all(len(v) == 4 for v in by.values())
    assert len({tuple(sorted(v)) for v in by.values()}) == 7
    alone = negative_sample(rows.limit(1), pool, rows.select("user_id", "item_id"), k=4).where("label = 0").collect()
    assert sorted(r.item_id for r in alone) in [sorted(v) for v in by.values()]  # the first draws as it would alone


def test_a_user_with_most_of_a_large_pool(spark):
    """1.0M of 1.1M items clicked: the remainder comes from the directory, in a
    join on (user, bucket), not from pairs of rows and gaps."""
    import time
    n, clicked = 1_100_000, 1_000_000
    pool = spark.range(n).selectExpr("id item_id", "id + 7 category")
    history = spark.range(n).where(f"(id * 7919) % {n} < {clicked}").selectExpr("1L user_id", "id item_id")
    rows = spark.range(2000).selectExpr("1L user_id", "id item_id", "id time_us", "id + 7 category")
    t0 = time.time()
    out = negative_sample(rows, pool, history, k=4, attempts=4, distinct_rows=True).where("label = 0").select("item_id", "category")
    got = [r.item_id for r in out.collect()]
    assert time.time() - t0 < 120
    assert len(got) == 8000 and all(i * 7919 % n >= clicked for i in got)
    assert len(set(got)) > 7000 and abs(sum(got) / len(got) / n - 0.5) < 0.03
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_stratified_keeps_label_shares(spark):
    df = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(400)], "k long, y int")
    s = stratified_sample(df, "y", ["k"], rate=0.5)
    got = {r.y: r["count"] for r in s.groupBy("y").count().collect()}
    assert got == {1: 50, 0: 150}
    assert stratified_sample(df, "y", ["k"], rate=2.0).count() == 400


def test_weighted_choice_inverse_cdf(spark):
    adj = spark.createDataFrame([(1, 10, 1.0), (1, 20, 3.0)], "g long, c long, w double")
    draws = spark.createDataFrame([(0, 1, 0.1), (1, 1, 0.3), (2, 1, 0.99)], "d long, g long, _u double")
    got = {r.d: r.c for r in weighted_choice(adj, "g", "c", "w", draws, ["d"]).collect()}
    assert got == {0: 10, 1: 20, 2: 20}


def test_draws_in_the_row_are_the_draws_by_joins(spark):
    """Users of every size, repeated and null keys: the same negatives whether
    they are drawn in the row or by joins, and no row for each draw."""
    from pyspark.sql import functions as F
    from recsmith.operators.sampling import negative_sample
    data = [(u, i, u * 100 + i, "a") for u in range(6) for i in range(u * 8)] + [(1, 1, 101, "a"), (None, 3, 1, "a"), (None, None, 2, "a")]
    rows = spark.createDataFrame(data, "user_id long, item_id long, time_us long, category string")
    pool = spark.range(42).selectExpr("id item_id", "concat('c', id) category")
    got = {}
    for most in (1000, 20, -1):
        out = negative_sample(rows, pool, rows.select("user_id", "item_id"), k=5, attempts=6, first_round=3, most_taken=most)
        got[most] = sorted(map(str, out.collect()))
        if most == 1000:
            assert "_a" not in out._jdf.queryExecution().optimizedPlan().toString().replace("_a#", " _a ").split()
    assert got[1000] == got[20] == got[-1]
    assert sum("label=0" in r for r in got[1000]) == 5 * len(data)
