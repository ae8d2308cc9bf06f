"""Radix percentiles against numpy: groups, columns, odd values, hot values."""

import random

import numpy as np
from pyspark.sql import functions as F

from recsmith.operators import radix as R

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def test_keys_keep_the_order_of_doubles():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), [0.0, -0.0, 1.0, -1.0, np.inf, -np.inf, 5e-324, -5e-324, 1e308]])
    keys = R.order_keys(x)
    order = np.argsort(keys, kind="stable")
    assert (np.diff(x[order]) >= 0).all() and np.array_equal(R.from_keys(keys), x + 0.0)
    assert R.order_keys(np.array([np.nan]))[0] > R.order_keys(np.array([np.inf]))[0]
    assert R.order_keys(np.array([0.0]))[0] == R.order_keys(np.array([-0.0]))[0]


def test_groups_and_columns_together(spark):
    rnd = random.Random(2)
    rows = []
    for g, n in [("a", 1), ("b", 2), (None, 50), ("c", 400)]:
        for k in range(n):
            rows.append((g, k % 3, rnd.choice([7.0, rnd.uniform(-1e6, 1e6), rnd.uniform(-1e-6, 1e-6)]), rnd.choice([None, k - 20])))
    df = spark.createDataFrame(rows, "g string, h int, x double, i int").repartition(4)
    got = {(r.g, r.column, r.prob): r.value for r in R.grouped_percentiles(df, ["x", "i"], PROBS, by=["g"]).collect()}
    want = {}
    for g in ("a", "b", None, "c"):
        for c in ("x", "i"):
            values = [r[2 if c == "x" else 3] for r in rows if r[0] == g]
            values = [v for v in values if v is not None]
            if values:
                want |= {(g, c, p): float(np.percentile(values, p * 100)) for p in PROBS}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k], rtol=1e-12, atol=1e-12) for k in want)
    two = {(r.g, r.h): r.value for r in R.grouped_percentiles(df, ["x"], [0.5], by=["g", "h"]).collect()}
    for g, h in two:
        assert np.isclose(two[g, h], np.median([r[2] for r in rows if r[:2] == (g, h)]))


def test_hot_value_nan_and_empty(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 12_000, 3.0).otherwise(F.col("id") / 1000).alias("x"))
    got = {r.prob: r.value for r in R.grouped_percentiles(df, ["x"], PROBS).collect()}
    x = np.where(np.arange(30_000) < 12_000, 3.0, np.arange(30_000) / 1000)
    assert all(np.isclose(got[p], np.percentile(x, p * 100)) for p in PROBS)
    odd = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,), (2.0,)], "x double")
    got = {r.prob: r.value for r in R.grouped_percentiles(odd, ["x"], [0.0, 0.4, 0.8, 1.0]).collect()}
    assert got[0.0] == float("-inf") and got[0.4] == 2.0 and got[0.8] == float("inf") and np.isnan(got[1.0])
    assert R.grouped_percentiles(odd.limit(0), ["x"], PROBS).collect() == []


def test_no_sort_of_the_rows(spark):
    """The counts are hash aggregates with partial sums; only histograms are windowed."""
    import inspect
    text = inspect.getsource(R)
    assert "repartitionByRange" not in text and "orderBy(\"_u\")" not in text and "percentile(" not in text
