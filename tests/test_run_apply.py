"""Groups streamed in runs: halos and states over partition borders."""

import random

import pytest

from recsmith.operators import apply as A


@pytest.fixture(scope="module")
def log(spark):
    rnd = random.Random(4)
    rows = [(u, rnd.randint(0, 9), float(k * 60)) for u, n in [(1, 700), (2, 1), (3, 2), (None, 90), (7, 300)] for k in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "user_id long, item_id long, time double").repartition(6)


def _key(r):
    return tuple(str(x) for x in r)


@pytest.fixture(params=[10_000, 7])
def small_batches(spark, request):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a group over many tasks, small as it is
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_gaps_equal_the_group_function(log, small_batches):
    schema = "user_id long, item_id long, time double, gap double"
    got = A.run_apply(log, "user_id", ["time", "item_id"], A.next_gap_run(), schema, after=1).collect()
    want = A.group_apply(log, ["user_id"], A.next_gap_pandas(), schema).collect()
    assert sorted(map(_key, got)) == sorted(map(_key, want)) and len(got) == 1093 - 5


def test_one_group_over_many_tasks(spark, log, small_batches):
    from recsmith.operators.encode import range_numbered
    from pyspark.sql import functions as F
    parts = range_numbered(log.where("user_id = 1"), [F.col("user_id").asc(), F.col("time").asc()]).groupBy("_pid").count().count()
    assert parts > 3
    got = A.run_apply(log, "user_id", ["time", "item_id"], A.position_run(), "user_id long, item_id long, time double, loc long", fold=A.count_fold()).collect()
    want = {}
    for r in sorted(log.collect(), key=lambda r: (r.time, r.item_id)):
        want.setdefault(r.user_id, []).append((r.time, r.item_id))
    assert {(r.user_id, r.loc): (r.time, r.item_id) for r in got} == {(u, k): v for u, rows in want.items() for k, v in enumerate(rows)}


@pytest.mark.parametrize("before,after", [(3, 0), (0, 4), (2, 5), (400, 400)])
def test_halos_of_any_width(log, small_batches, before, after):
    def around(frame, start, stop):
        out = frame.iloc[start:stop].copy()
        t = frame["time"].tolist()
        out["b"] = [",".join(str(int(x)) for x in t[max(0, k - before):k]) for k in range(start, stop)]
        out["a"] = [",".join(str(int(x)) for x in t[k + 1:k + 1 + after]) for k in range(start, stop)]
        return out[["user_id", "time", "b", "a"]]

    got = {(r.user_id, r.time): (r.b, r.a) for r in
           A.run_apply(log, "user_id", ["time"], around, "user_id long, time double, b string, a string", before, after).collect()}
    times = {}
    for r in log.collect():
        times.setdefault(r.user_id, []).append(int(r.time))
    want = {}
    for u, t in times.items():
        t.sort()
        for k, v in enumerate(t):
            want[u, float(v)] = (",".join(map(str, t[max(0, k - before):k])), ",".join(map(str, t[k + 1:k + 1 + after])))
    assert got == want


def test_empty(log):
    none = A.run_apply(log.limit(0), "user_id", ["time"], A.next_gap_run(), "user_id long, item_id long, time double, gap double", before=1, after=1)
    assert none.collect() == []
