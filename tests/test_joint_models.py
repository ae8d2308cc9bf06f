"""Models fitted together: against plain numpy, planted signals, one loop of passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.operators import logistic as lg
from recsmith.operators import models as M


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 3))
    y = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.8 * x[:, 1] + 0.3)))).astype(int)
    rows = [(k, *map(float, x[k]), int(y[k])) for k in range(600)]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y int").repartition(5)


def _plain(x, y, w, C):
    """Minimum of sum w * log loss + |b|_1 / C by proximal gradient steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    b, v, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    rate = 4 / np.linalg.eigvalsh((x * w[:, None]).T @ x)[-1]
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-x @ v))
        new = v - rate * (x.T @ (w * (p - y)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate / C, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, b, t = new + (t - 1) / t2 * (new - b), new, t2
    return b


def test_coefficients_of_many_models(table):
    rows = sorted(table.collect(), key=lambda r: r.k)
    x, y = np.array([[r.a, r.b, r.c] for r in rows]), np.array([r.y for r in rows])
    k = np.arange(600)
    weights = [k % 2, (k % 3 == 0) * 3, np.ones(600), np.ones(600), k < 40]
    columns = [F.col("k") % 2, F.when(F.col("k") % 3 == 0, 3).otherwise(0), F.lit(1), F.lit(1), F.col("k") < 40]
    C = [1.0, 0.5, 0.02, 10.0, 1.0]
    fitted = lg.joint_fit(lg.model_rows(table, ["a", "b", "c"], "y", columns), 3, C)
    for j in range(5):
        assert np.allclose(fitted.coefficients[j], _plain(x, y, weights[j].astype(float), C[j]), atol=1e-5), j
    assert fitted.passes < 30 and fitted.coefficients[2][2] == 0.0  # the penalty takes the column without signal


def test_fifty_fits_take_one_loop_of_jobs(table, monkeypatch):
    passes = []
    plain = lg._summed
    monkeypatch.setattr(lg, "_summed", lambda *a: (passes.append(1), plain(*a))[1])
    curve = M.learning_curve(table, ["a", "b", "c"], "y", "k").collect()
    assert len(passes) < 40 and len(curve) == 10
    assert [r.fraction for r in curve] == [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
    assert all(0.6 < r.validation_accuracy < 0.95 for r in curve[3:])
    assert curve[0].train_accuracy >= curve[-1].train_accuracy - 0.1  # small samples are learned by heart


def test_validation_curve_of_a_planted_signal(table):
    rows = {r.C: r for r in M.validation_curve(table, ["a", "b", "c"], "y", "k", values=(0.001, 1.0), k=4).collect()}
    assert rows[1.0].validation_mean > 0.7 > rows[0.001].validation_mean  # at 0.001 only the intercept is left
    assert all(r.train_std >= 0 and 0 <= r.validation_std < 0.2 for r in rows.values())
    cv = M.cross_validate(table, ["a", "b", "c"], "y", "k", k=4).collect()
    assert abs(np.mean([r.accuracy for r in cv]) - rows[1.0].validation_mean) < 1e-12


def test_unusable_rows_and_one_class(spark, table):
    odd = spark.createDataFrame([(1000, None, 1.0, 1.0, 1), (1001, float("nan"), 1.0, 1.0, 0), (1002, 1.0, 1.0, 1.0, None)], table.schema)
    a, _ = M.train_logistic_l1(table, ["a", "b", "c"], "y")
    b, coefs = M.train_logistic_l1(table.union(odd), ["a", "b", "c"], "y")
    assert np.allclose(a, b, atol=1e-7) and [r.feature for r in coefs.collect()] == ["a", "b", "c", "(intercept)"]
    votes = {r.k: r.prediction for r in M.bagged_predictions(table.union(odd), ["a", "b", "c"], "y", "k", n=3).collect()}
    assert votes[1000] is None and votes[1001] is None and votes[1002] in (0, 1) and len(votes) == 603
    only = M.bagged_predictions(table.withColumn("y", F.lit(1)), ["a"], "y", "k", n=2)
    assert {r.prediction for r in only.collect()} == {1}
    with pytest.raises(ValueError):
        lg.joint_fit(table, 3000, [1.0])


def test_factorization_machine_finds_an_interaction(spark):
    """y depends on the pair of codes only: equal parity says 1."""
    rng = np.random.default_rng(5)
    u, i = rng.integers(1, 13, 3000), rng.integers(1, 13, 3000)
    rows = [(int(a), int(b), int(a % 2 == b % 2)) for a, b in zip(u, i, strict=True)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, label int")
    params, bias = M.train_fm(df, ["user_id", "item_id"], "label", factor_size=4, steps=12)
    got = M.score_fm(df.distinct(), ["user_id", "item_id"], params, bias, 4).collect()
    assert np.mean([(r.prob > 0.5) == r.label for r in got]) > 0.95
    # the score is M6 + M8 on the trained tables
    from recsmith.functions.columns import sigmoid
    from recsmith.operators import features as fe
    from recsmith.operators import vectors as V
    fm = V.fm_interaction(df.distinct(), ["user_id", "item_id"], params, dim=4)
    lin = fe.linear_logit(df.distinct(), ["user_id", "item_id"], ["user_id", "item_id"], params)
    both = fm.join(lin, ["user_id", "item_id"]).select("user_id", "item_id", sigmoid(F.col("fm") + F.col("logit") + bias).alias("p")).collect()
    want = {(r.user_id, r.item_id): r.prob for r in got}
    assert all(abs(want[r.user_id, r.item_id] - r.p) < 1e-12 for r in both) and len(both) == len(want)
    cold = spark.createDataFrame([(99, 99, 0), (None, 1, 0)], "user_id long, item_id long, label int")
    assert all(0 < r.prob < 1 for r in M.score_fm(cold, ["user_id", "item_id"], params, bias, 4).collect())
