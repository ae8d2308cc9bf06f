"""MLlib-backed operators: invariants (M1..M3, E7)."""


from recsmith.operators import features as fe
from recsmith.operators import models as M


def _data(spark):
    rows = [(i, float(i % 7), float((i * 3) % 5), 1 if (i % 7) > 3 else 0, None if i % 4 == 0 else float(i % 7))
            for i in range(120)]
    return spark.createDataFrame(rows, "k long, a double, b double, y int, z double")


def test_logistic_coefficients_and_cv(spark):
    df = _data(spark)
    _, coefs = M.train_logistic_l1(df, ["a", "b"], "y")
    names = [r.feature for r in coefs.collect()]
    assert names == ["a", "b", "(intercept)"]
    cv = M.cross_validate(df, ["a", "b"], "y", "k", k=3).collect()
    assert len(cv) == 3 and all(0.0 <= r.accuracy <= 1.0 for r in cv)


def test_bagging_output_is_binary_and_deterministic(spark):
    df = _data(spark)
    a = M.bagged_predictions(df, ["a", "b"], "y", "k", n=3).collect()
    b = M.bagged_predictions(df, ["a", "b"], "y", "k", n=3).collect()
    assert {r.prediction for r in a} <= {0, 1} and len(a) == 120
    assert sorted(tuple(r) for r in a) == sorted(tuple(r) for r in b)


def test_model_fill_fills_only_nulls(spark):
    df = _data(spark)
    model = fe.fit_model_fill(df, "z", ["a", "b"], mode="regression", num_trees=5)
    out = {r.k: r.z for r in fe.apply_model_fill(df, "z", ["a", "b"], model).collect()}
    orig = {r.k: r.z for r in df.collect()}
    assert all(v is not None for v in out.values())
    assert all(out[k] == v for k, v in orig.items() if v is not None)


def test_forest_rows_are_dealt_over_tasks_by_their_size(spark, monkeypatch):
    """A forest of 500 trees keeps 2 KB a row: 40,000 narrow rows of one task
    are too many for one."""
    from pyspark.ml import Pipeline
    seen = []
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: seen.append(df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()))
    df = spark.range(0, 40_000, numPartitions=1).selectExpr("cast(id % 7 as double) a", "if(id % 10 = 0, null, cast(id % 2 as int)) y")
    fe.fit_model_fill(df, "y", ["a"], mode="classification")
    assert sum(seen[0]) == 36_000 and max(seen[0]) * 2_000 <= fe.FOREST_TASK_BYTES
    fe.fit_model_fill(df.limit(1000), "y", ["a"], mode="classification", num_trees=5)
    assert seen[1] == [900]  # few rows stay as they come
