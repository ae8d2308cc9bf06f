"""Many L1 logistic models fitted together (M1..M5).

Folds, bags, fractions and values of C are models over the same rows that
differ in the rows' weights and in C. One pass over the data adds up loss,
gradient and curvature of all models; the driver takes a proximal Newton step
for each (coordinate descent on the quadratic model, the intercept without
penalty) and halves steps that do not lower the objective. So fifty models
take as many jobs as one. What reaches the driver has a fixed size, models x
features^2, which is checked; sums are added up in tasks first.

The objective is sum_i weight_i * log loss_i + |w|_1 / C, the one of scikit-learn's
``C`` and of MLlib's ``regParam = 1 / (C * n)``.

Defined results: rows with a null or NaN feature or label take no part in a fit
and have no prediction; a model without weighted rows, or of one class only,
predicts that class (intercept at its bound).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.session import cut_lineage, shuffle_partitions

#: Numbers that one pass may bring to the driver (models x features^2).
MAX_CELLS = 4_000_000
#: Largest absolute value of a coefficient (separable data have no optimum).
BOUND = 30.0


@dataclass
class Fitted:
    """Coefficients (models x features, the intercept last) and passes taken."""

    coefficients: np.ndarray
    passes: int


def model_rows(df: DataFrame, cols: list[str], label: str, weights: list[Column], keep: list[str] | None = None,
               tests: list[Column] | None = None) -> DataFrame:
    """(keep..., x, y, w, t): features, label, and for each model the weight of
    the row in training and in testing; written once, read by every pass."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    return cut_lineage(df.select(*(keep or []), x.alias("x"), F.col(label).cast("double").alias("y"),
                                 F.array(*[w.cast("int") for w in weights]).alias("w"),
                                 F.array(*[t.cast("int") for t in tests or []]).cast("array<int>").alias("t")))


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _summed(data: DataFrame, columns: list[str], size: int, add) -> np.ndarray:
    """Sum over all batches of `add(batch)`, an array of `size` numbers: one row
    a task, added up again in a bounded number of tasks."""

    def scan(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += add(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def again(batches):
        total = np.zeros(size)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                total += np.frombuffer(s)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    parts = data.select(*columns).mapInArrow(scan, "s binary")
    few = parts.repartition(min(16, shuffle_partitions(data.sparkSession))).mapInArrow(again, "s binary")
    return sum((np.frombuffer(r.s) for r in few.collect()), np.zeros(size))


def _batch(batch: pa.RecordBatch, d: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features with a one behind them, labels and weights of the usable rows."""
    x = _lists(batch.column(0), d)
    y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
    w = _lists(batch.column(2), m)
    good = np.isfinite(x).all(axis=1) & np.isfinite(y)
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)[good], y[good], w[good]


def _pass(coefficients: np.ndarray, d: int):
    m, k = len(coefficients), d + 1

    def add(batch: pa.RecordBatch) -> np.ndarray:
        x, y, w = _batch(batch, d, m)
        z = x @ coefficients.T
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        loss = (w * (np.logaddexp(0, z) - y[:, None] * z)).sum(axis=0)
        gradient = (w * (p - y[:, None])).T @ x
        bend = w * p * (1 - p)
        curvature = np.stack([(x * bend[:, [j]]).T @ x for j in range(m)])
        return np.concatenate([loss, gradient.ravel(), curvature.ravel(), (w * y[:, None]).sum(axis=0), w.sum(axis=0)])

    return add, m * (3 + k + k * k)


def _newton(w: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, penalty: float) -> np.ndarray:
    """Minimum of the quadratic model plus the penalty, by coordinate descent."""
    h = curvature + 1e-9 * np.eye(len(w)) * max(1.0, np.trace(curvature))
    new, move = w.copy(), np.zeros(len(w))
    for _ in range(1000):
        largest = 0.0
        for j in range(len(w)):
            slope = gradient[j] + h[j] @ move
            if j == len(w) - 1:
                value = new[j] - slope / h[j, j]
            else:
                raw = h[j, j] * new[j] - slope
                value = np.sign(raw) * max(abs(raw) - penalty, 0.0) / h[j, j]
            value = min(max(value, -BOUND), BOUND)
            step = value - new[j]
            if step:
                new[j] = value
                move[j] += step
                largest = max(largest, abs(step))
        if largest < 1e-10:
            break
    return new


def joint_fit(data: DataFrame, d: int, C: list[float], max_passes: int = 60, tol: float = 1e-9) -> Fitted:
    """Fits a model for each value of ``C`` and its weight in column ``w``."""
    m, k = len(C), d + 1
    if m * k * k > MAX_CELLS:
        raise ValueError(f"{m} models of {d} features need more than {MAX_CELLS} numbers on the driver")
    penalty = 1.0 / np.array(C)
    best = np.zeros((m, k))
    trial, held = best.copy(), [None] * m  # held: (objective, step) at best
    open_ = np.ones(m, dtype=bool)
    for turn in range(1, max_passes + 1):
        add, size = _pass(trial, d)
        total = _summed(data, ["x", "y", "w"], size, add)
        loss, gradient = total[:m], total[m:m + m * k].reshape(m, k)
        curvature = total[m + m * k:m + m * k + m * k * k].reshape(m, k, k)
        ones, rows = total[-2 * m:-m], total[-m:]
        for j in np.flatnonzero(open_):
            if ones[j] == 0 or ones[j] == rows[j]:  # one class, or no rows
                best[j] = 0.0
                best[j, -1] = -BOUND if ones[j] == 0 else BOUND
                open_[j] = False
                trial[j] = best[j]
                continue
            objective = loss[j] + penalty[j] * np.abs(trial[j, :-1]).sum()
            if held[j] is not None and objective > held[j][0] + 1e-12 * abs(held[j][0]):
                step = held[j][1] / 2
                held[j] = (held[j][0], step)
                trial[j] = best[j] + step
                open_[j] = np.abs(step).max() > 1e-12
                continue
            gain = np.inf if held[j] is None else held[j][0] - objective
            best[j] = trial[j]
            step = _newton(best[j], gradient[j], curvature[j], penalty[j]) - best[j]
            held[j] = (objective, step)
            trial[j] = best[j] + step
            open_[j] = np.abs(step).max() > tol and gain > 1e-14 * max(1.0, abs(objective))
        if not open_.any():
            break
    return Fitted(best, turn)


def joint_accuracy(data: DataFrame, d: int, coefficients: np.ndarray, column: str) -> np.ndarray:
    """Share of right classes of each model over its weighted rows (``column``:
    w or t), all in one pass; NaN without rows."""
    m = len(coefficients)

    def add(batch: pa.RecordBatch) -> np.ndarray:
        x, y, w = _batch(batch, d, m)
        right = (x @ coefficients.T > 0) == (y[:, None] > 0.5)
        return np.concatenate([(w * right).sum(axis=0), w.sum(axis=0)])

    total = _summed(data, ["x", "y", column], 2 * m, add)
    with np.errstate(invalid="ignore", divide="ignore"):
        return total[:m] / total[m:]


def votes(data: DataFrame, d: int, coefficients: np.ndarray, key: str, key_type: str, out: str = "votes") -> DataFrame:
    """(key, votes): how many models say 1; null for rows without a prediction."""

    def scan(batches):
        for batch in batches:
            x = _lists(batch.column(1), d)
            z = np.concatenate([x, np.ones((len(x), 1))], axis=1) @ coefficients.T
            n = (z > 0).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32(), mask=~np.isfinite(x).all(axis=1))], names=[key, out])

    return data.select(key, "x").mapInArrow(scan, f"`{key}` {key_type}, {out} int")
