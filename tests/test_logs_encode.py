"""Windows, splits, dense ids and stable encodings (W*, A*, E1..E3, E8)."""

from pyspark.sql import functions as F

from recsmith.operators import encode as E
from recsmith.operators import logs as L


def _log(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, time_us long")


def test_single_click_user_has_empty_history_and_is_test(spark):
    df = _log(spark, [(1, 10, 5)]).withColumn("code", F.lit(7))
    out = L.click_history(df, {"code": "hist"}, n=3, with_split=True).collect()[0]
    assert out.hist == [0, 0, 0] and out.split == "test"


def test_equal_times_break_ties_by_item(spark):
    df = _log(spark, [(1, 20, 5), (1, 10, 5), (1, 30, 9)])
    locs = {r.item_id: r.loc for r in L.sequence_position(df).collect()}
    assert locs == {10: 0, 20: 1, 30: 2}
    s = {r.item_id: r.split for r in L.leave_two_out_split(df).collect()}
    assert s == {30: "test", 20: "validate", 10: "train"}
    s2 = {r.item_id: r.split for r in L.leave_two_out_split(df, holdout="earliest").collect()}
    assert s2 == {10: "test", 20: "validate", 30: "train"}


def test_latest_click_keeps_last(spark):
    df = spark.createDataFrame([(1, 10, 5, "a"), (1, 10, 9, "b"), (2, 10, 1, "c")],
                               "user_id long, item_id long, time_us long, category string")
    got = {(r.user_id, r.item_id): (r.time_us, r.category) for r in L.latest_click(df).collect()}
    assert got == {(1, 10): (9, "b"), (2, 10): (1, "c")}


def test_dense_ids_consecutive_across_partitions(spark):
    vals = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("v"))
    ids = E.dense_ids(vals, "v", start=1).collect()
    got = sorted((r.v, r.id) for r in ids)
    assert [i for _, i in got] == list(range(1, 5001))


def test_append_encoding_keeps_codes_and_nulls_are_values(spark):
    first = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    st1 = E.fit_encoding(first, "c")
    codes1 = {r.value: r.id for r in st1.collect()}
    assert codes1 == {None: 1, "a": 2, "b": 3}
    second = spark.createDataFrame([("z",), ("a",), ("c",)], "c string")
    st2 = E.fit_encoding(second, "c", st1)
    codes2 = {r.value: r.id for r in st2.collect()}
    assert {k: codes2[k] for k in codes1} == codes1 and codes2["c"] == 4 and codes2["z"] == 5
    test = spark.createDataFrame([("q",), ("a",), (None,)], "c string")
    applied = [r.c for r in E.apply_encoding(test, "c", st2).collect()]
    assert sorted(applied) == [0, 1, 2]
    unk = E.fit_encoding(first, "c", is_unk=True)
    assert min(r.id for r in unk.collect()) == 2
    assert [r.c for r in E.apply_encoding(spark.createDataFrame([("q",)], "c string"), "c", unk, is_unk=True)
            .collect()] == [1]


def test_decode_round_trip_and_label_encode(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "c string")
    st = E.fit_encoding(df, "c")
    enc = E.apply_encoding(df, "c", st)
    dec = E.decode(enc, "c", st)
    assert sorted(r.c for r in dec.collect()) == ["x", "x", "y"]
    lab = E.label_encode(df, "c")
    assert sorted(r.c for r in lab.collect()) == [0, 0, 1]


def test_upper_median(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 3, 3, 9, 7]], "d int")
    assert L.upper_median(df, "d").collect()[0].median == sorted([5, 1, 3, 3, 9, 7])[3]


def test_time_gap_drops_last(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 7200.0), (2, 3, 5.0)], "user_id long, item_id long, time double")
    got = [(r.item_id, r.gap) for r in L.time_gap(df, scale=3600.0).collect()]
    assert got == [(1, 2.0)]
