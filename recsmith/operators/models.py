"""Model fitting and model selection (M1..M5, M7).

Folds, bootstraps and training-size fractions come from md5 of the row key, so
every split is reproducible and recomputable. All models of an operator are
fitted together (``operators/logistic.py``): one pass over the data a step, for
five folds as for fifty.
"""

from __future__ import annotations

import statistics

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions.columns import hash32, sigmoid, uniform01
from recsmith.operators import logistic as lg
from recsmith.operators.sampling import poisson_times
from recsmith.session import as_table

SEED = 39


def train_logistic_l1(df: DataFrame, cols: list[str], label: str, C: float = 1.0) -> tuple[np.ndarray, DataFrame]:
    """M1: (coefficients, intercept last; the same as a table)."""
    fitted = lg.joint_fit(lg.model_rows(df, cols, label, [F.lit(1)]), len(cols), [C]).coefficients[0]
    rows = [(c, float(w)) for c, w in zip([*cols, "(intercept)"], fitted, strict=True)]
    return fitted, df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def fold_id(key: str | list[str], k: int) -> Column:
    keys = [key] if isinstance(key, str) else key
    return F.pmod(hash32(*keys, F.lit(SEED)), F.lit(k)).cast("int")


def _folds(df: DataFrame, key: str, k: int) -> DataFrame:
    return df.withColumn("_fold", fold_id(key, k)).withColumn("_u", uniform01(key, F.lit("lc")))


def cross_validate(df: DataFrame, cols: list[str], label: str, key: str, k: int = 5, C: float = 1.0) -> DataFrame:
    """M2: k-fold accuracy per fold (md5 fold ids)."""
    data = lg.model_rows(_folds(df, key, k), cols, label, [F.col("_fold") != f for f in range(k)],
                         tests=[F.col("_fold") == f for f in range(k)])
    found = lg.joint_accuracy(data, len(cols), lg.joint_fit(data, len(cols), [C] * k).coefficients, "t")
    return df.sparkSession.createDataFrame([(f, float(a)) for f, a in enumerate(found)], "fold int, accuracy double")


def bagged_predictions(df: DataFrame, cols: list[str], label: str, key: str, n: int = 20,
                       fraction: float = 0.8, C: float = 1.0) -> DataFrame:
    """M3 (+N3): fit on ``n`` bootstraps (with replacement: a row's weight is how
    often it is drawn), average the class predictions and cast to int (1 only
    when all models agree)."""
    data = lg.model_rows(df, cols, label, [poisson_times([F.col(key)], fraction, SEED + b) for b in range(n)], keep=[key])
    fitted = lg.joint_fit(data, len(cols), [C] * n).coefficients
    found = lg.votes(data, len(cols), fitted, key, dict(df.dtypes)[key])
    return found.select(key, F.floor(F.col("votes") / F.lit(float(n))).cast("int").alias("prediction"))


def learning_curve(df: DataFrame, cols: list[str], label: str, key: str,
                   fractions=(0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0), k: int = 5,
                   C: float = 1.0) -> DataFrame:
    """M4: train / validation accuracy at growing training sizes (a md5
    prefix of each fold's training rows), averaged over folds with rows."""
    specs = [(q, f) for q in fractions for f in range(k)]
    data = lg.model_rows(_folds(df, key, k), cols, label, [(F.col("_fold") != f) & (F.col("_u") < q) for q, f in specs],
                         tests=[F.col("_fold") == f for _, f in specs])
    fitted = lg.joint_fit(data, len(cols), [C] * len(specs)).coefficients
    train, test = (lg.joint_accuracy(data, len(cols), fitted, c).reshape(len(fractions), k) for c in ("w", "t"))
    rows = []
    for q, a, b in zip(fractions, train, test, strict=True):
        some = [f for f in range(k) if not np.isnan(a[f]) and not np.isnan(b[f])]
        rows.append((float(q), *[float(statistics.fmean(x[some])) if some else float("nan") for x in (a, b)]))
    return df.sparkSession.createDataFrame(rows, "fraction double, train_accuracy double, validation_accuracy double")


def validation_curve(df: DataFrame, cols: list[str], label: str, key: str, values=(0.01, 0.1, 1.0, 10.0),
                     k: int = 5) -> DataFrame:
    """M5: mean and population std of train / validation accuracy per value
    of the regularisation constant C (the parameter actually given, Q13)."""
    specs = [(c, f) for c in values for f in range(k)]
    data = lg.model_rows(_folds(df, key, k), cols, label, [F.col("_fold") != f for _, f in specs], tests=[F.col("_fold") == f for _, f in specs])
    fitted = lg.joint_fit(data, len(cols), [c for c, _ in specs]).coefficients
    train, test = (lg.joint_accuracy(data, len(cols), fitted, c).reshape(len(values), k) for c in ("w", "t"))
    rows = [(float(c), float(a.mean()), float(a.std()), float(b.mean()), float(b.std())) for c, a, b in zip(values, train, test, strict=True)]
    return df.sparkSession.createDataFrame(
        rows, "C double, train_mean double, train_std double, validation_mean double, validation_std double")


# ---------------------------------------------------------------------- M7

def _fm_forward(rows: DataFrame, fields: list[str], params: DataFrame, dim: int) -> DataFrame:
    """``rows`` with each field's parameters, the sums over the fields and the
    probability; codes without parameters count as zeros."""
    out = rows
    for i, f in enumerate(fields):
        side = params.where(F.col("field") == f).select(F.col("code").alias(f"_code{i}"), F.col("weight").alias(f"_w{i}"), F.col("vec").alias(f"_v{i}"))
        out = out.join(side, out[f] == side[f"_code{i}"], "left").drop(f"_code{i}")
        out = out.withColumn(f"_w{i}", F.coalesce(f"_w{i}", F.lit(0.0)))
        out = out.withColumn(f"_v{i}", F.coalesce(f"_v{i}", F.array_repeat(F.lit(0.0), dim)))
    sums = [sum((F.col(f"_v{i}")[d] for i in range(len(fields))), F.lit(0.0)) for d in range(dim)]
    squares = sum((F.col(f"_v{i}")[d] * F.col(f"_v{i}")[d] for i in range(len(fields)) for d in range(dim)), F.lit(0.0))
    linear = sum((F.col(f"_w{i}") for i in range(len(fields))), F.col("_bias"))
    out = out.withColumn("_s", F.array(*sums))
    return out.withColumn("_p", sigmoid(linear + 0.5 * (sum((F.col("_s")[d] * F.col("_s")[d] for d in range(dim)), F.lit(0.0)) - squares)))


def train_fm(df: DataFrame, fields: list[str], label: str, factor_size: int = 8, seed: int = SEED, steps: int = 15,
             rate: float = 0.3, l2: float = 1e-4) -> tuple[DataFrame, float]:
    """M7: factorization machine on code fields. Returns the table (field, code,
    weight, vec) and the bias.

    Rows of the same codes are one row with their number and the sum of their
    labels. The parameters are rows, one for each (field, code). A step joins them to
    the rows, one field after the other, and adds up the gradients per (field,
    code) (map-side combined, so a frequent code is no hot key); AdaGrad keeps
    its sums beside the parameters. Only the bias, one number, is on the
    driver. Starting vectors are drawn from md5 of field, code and place."""
    rows = as_table(df.select(*fields, F.col(label).cast("double").alias("_y")).where(F.col("_y").isNotNull())
                    .groupBy(*fields).agg(F.sum("_y").alias("_y"), F.count(F.lit(1)).alias("_rows")))
    params = None
    for f in fields:
        codes = rows.where(F.col(f).isNotNull()).select(F.lit(f).alias("field"), F.col(f).cast("bigint").alias("code")).distinct()
        params = codes if params is None else params.unionByName(codes)
    start = F.array(*[(uniform01("field", "code", F.lit(d), F.lit(seed)) - 0.5) * 0.2 for d in range(factor_size)])
    params = as_table(params.select("field", "code", F.lit(0.0).alias("weight"), start.alias("vec"), F.lit(0.0).alias("_aw"), F.lit(0.0).alias("_av")))
    bias = held = 0.0
    for _ in range(steps):
        seen = _fm_forward(rows.withColumn("_bias", F.lit(bias)), fields, params, factor_size)
        # rows of the same codes have the same probability: one entry for all
        seen = seen.withColumn("_r", F.col("_p") * F.col("_rows") - F.col("_y"))
        entry = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("bigint").alias("code"), F.col("_r").alias("r"), F.col("_rows").alias("n"),
                                             F.zip_with("_s", f"_v{i}", lambda s, v: F.col("_r") * (s - v)).alias("g"))
                                    for i, f in enumerate(fields)])).alias("e")
        gradient = as_table(seen.select(entry).groupBy("e.field", "e.code").agg(
            F.sum("e.r").alias("_gw"), F.sum("e.n").alias("_n"), F.array(*[F.sum(F.col("e.g")[d]) for d in range(factor_size)]).alias("_gv")))
        # rows have one entry a field: the first field's entries are all of them
        total = gradient.where(F.col("field") == fields[0]).agg(F.sum("_gw").alias("g"), F.sum("_n").alias("n")).first()
        if total.n:
            slope = total.g / total.n
            held += slope * slope
            bias -= rate * slope / max(held, 1e-12) ** 0.5
        # mean gradients, so that a step does not depend on how frequent a code is
        gw = F.col("_gw") / F.col("_n") + l2 * F.col("weight")
        moved = (params.join(gradient, ["field", "code"]).withColumn("_g", gw)
                 .withColumn("_gv", F.zip_with("_gv", "vec", lambda g, v: g / F.col("_n") + l2 * v))
                 .withColumn("_aw", F.col("_aw") + F.col("_g") * F.col("_g"))
                 .withColumn("_av", F.col("_av") + F.aggregate("_gv", F.lit(0.0), lambda s, g: s + g * g) / factor_size))
        params = as_table(moved.select(
            "field", "code", (F.col("weight") - rate * F.col("_g") / F.sqrt(F.greatest("_aw", F.lit(1e-12)))).alias("weight"),
            F.zip_with("vec", "_gv", lambda v, g: v - rate * g / F.sqrt(F.greatest(F.col("_av"), F.lit(1e-12)))).alias("vec"), "_aw", "_av"))
    return params.select("field", "code", "weight", "vec"), bias


def score_fm(df: DataFrame, fields: list[str], params: DataFrame, bias: float, factor_size: int = 8, out: str = "prob") -> DataFrame:
    """``df`` with the probability of a trained factorization machine."""
    seen = _fm_forward(df.withColumn("_bias", F.lit(bias)), fields, params, factor_size)
    return seen.select(*df.columns, F.col("_p").alias(out))
