"""Feature operators: quirk decisions Q5, Q6, Q7 and fit/apply state."""

from pyspark.sql import functions as F

from recsmith.operators import features as fe


def test_one_hot_aligned_to_fit(spark):
    train = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, c string")
    test = spark.createDataFrame([(4, "a"), (5, "z")], "k long, c string")
    values = fe.fit_one_hot(train, "c")
    out = fe.apply_one_hot(test, "c", values)
    assert out.columns == ["k", "c_a", "c_b", "c_c"]
    got = {r.k: (r.c_a, r.c_b, r.c_c) for r in out.collect()}
    assert got == {4: (1, 0, 0), 5: (0, 0, 0)}


def test_binarize_zero_threshold_and_unseen_count(spark):
    from recsmith.functions.columns import threshold_binarize
    df = spark.createDataFrame([(0.0,), (0.5,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(threshold_binarize("x", 0.0)).collect()] == [0, 1, 0]
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    test = spark.createDataFrame([("a",), ("b",), ("new",)], "v string")
    out = fe.apply_count_binarize(test, "v", fe.fit_count_binarize(train, "v"), min_count=2, out="f")
    assert sorted((r.v, r.f) for r in out.collect()) == [("a", 1), ("b", 0), ("new", 0)]


def test_scaler_state_is_per_field_and_reused(spark):
    train = spark.createDataFrame([(0.0, 10.0), (2.0, 30.0)], "a double, b double")
    test = spark.createDataFrame([(1.0, 20.0)], "a double, b double")
    st = fe.fit_standard_scale(train, ["a", "b"])
    r = fe.apply_standard_scale(test, ["a", "b"], st).collect()[0]
    assert r.a == 0.0 and r.b == 0.0


def test_feature_spec_and_linear_logit(spark):
    from recsmith.operators import encode as E
    df = spark.createDataFrame([("u1", "i1"), ("u2", "i1")], "u string, i string")
    enc, states = E.encode_fields(df, ["u", "i"])
    spec = spark.createDataFrame([("u", "sparse", "u", 1, 4), ("i", "sparse", "i", 1, 4), ("hist", "sequence", "i", 5, 4)],
                                 "field string, kind string, embedding_name string, max_len int, dim int")
    got = {r.field: (r.vocab_size, r.table_size) for r in fe.feature_spec(states, spec).collect()}
    assert got == {"u": (3, 3), "i": (2, 2), "hist": (None, 2)}
    w = fe.derived_weights(states)
    logit = fe.linear_logit(enc.withColumn("k", enc.u), ["k"], ["u", "i"], w).collect()
    wd = {(r.field, r.code): r.weight for r in w.collect()}
    for r in logit:
        assert abs(r.logit - (wd[("u", r.k)] + wd[("i", 1)])) < 1e-12


def test_sparse_one_hot_has_no_limit(spark):
    train = spark.range(3000).select(F.col("id").cast("string").alias("c")).union(spark.createDataFrame([(None,)], "c string"))
    state = fe.fit_one_hot_sparse(train, "c")
    assert state.count() == 3001 and state.where("value is null").first().id == 0
    out = fe.apply_one_hot_sparse(spark.createDataFrame([("7",), (None,), ("new",)], "c string"), "c", state)
    codes = {r.value: r.id for r in state.where("value = '7' or value is null").collect()}
    assert {r.c: list(r.c_ones) for r in out.collect()} == {"7": [codes["7"]], None: [0], "new": []}


def test_logit_keeps_rows_that_repeat_a_key(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "k long, f long")
    w = spark.createDataFrame([("f", 5, 0.25)], "field string, code long, weight double")
    assert sorted((r.k, r.logit) for r in fe.linear_logit(df, ["k"], ["f"], w).collect()) == [(1, 0.25), (1, 0.25), (2, 0.0)]


def test_contingency_and_density_drop_nothing(spark):
    from recsmith.operators import eda
    df = spark.createDataFrame([("a", 0), ("a", 2), (None, None), ("a", None), (None, 1)], "f string, y int")
    got = {(r.f, r.y): r["count"] for r in eda.counts_by_label(df, "f", "y").collect()}
    assert got == {("a", 0): 1, ("a", 2): 1, (None, None): 1, ("a", None): 1, (None, 1): 1}
    rows = [("x", float(v)) for v in range(50)] + [("x", 1e9), (None, 1.0), (None, 2.0), ("same", 3.0), ("same", 3.0)]
    dens = eda.kde_by_category(spark.createDataFrame(rows, "c string, v double"), "v", "c", grid=100).collect()
    for c in ("x", None, "same"):
        part = [r for r in dens if r.c == c]
        assert sorted(r.grid_idx for r in part) == list(range(100))
        assert all((r.density is None) == (c == "same") for r in part)


def test_bootstrap_does_not_depend_on_partitions(spark):
    from recsmith.operators.sampling import bootstrap
    df = spark.range(4000)
    one = sorted(r.id for r in bootstrap(df.repartition(3), 0.8, 5).collect())
    assert one == sorted(r.id for r in bootstrap(df.coalesce(1), 0.8, 5).collect())
    assert 3000 < len(one) < 3400 and len(set(one)) < len(one)
