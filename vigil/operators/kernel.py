"""Support vector machines with a radial kernel, on Nyström features.

Landmark rows are drawn in rounds, each row with a chance that grows with its
squared distance to the landmarks so far; the draw is a hash of the row's values
and the seed, so it depends neither on partitions nor on row order.  A row's
features are its kernel values with the landmarks, whitened by the landmarks' own
kernel matrix: their inner products approximate the kernel.  Weights minimise

    |w|^2 / 2 + C * sum(max(0, 1 - y f(x))^2)               (classes 0 and 1)
    |w|^2 / 2 + C * sum(max(0, |y - f(x)| - epsilon)^2)     (regression)

by Newton steps with halving: a step is one pass that adds up loss, gradient and
curvature, (landmarks + 1) squared numbers per task.

Rows with a null or NaN in a column or the target are left out of the fit and
get a null value in prediction.  A column without spread counts as 0.  Without
rows the model is constant 0.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.profile import c


class KernelModel(NamedTuple):
    cols: tuple[str, ...]
    centre: np.ndarray
    scale: np.ndarray
    gamma: float
    landmarks: np.ndarray  # standardised
    whiten: np.ndarray
    weights: np.ndarray  # the last one is the intercept

    def features(self, x: np.ndarray) -> np.ndarray:
        """Whitened kernel values of rows of raw columns, and a 1."""
        return np.column_stack([_kernel((x - self.centre) / self.scale, self.landmarks, self.gamma) @ self.whiten, np.ones(len(x))])

    def value(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights


def _square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T, 0.0)


def _kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    return np.exp(-gamma * _square_distances(x, y))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]).astype(float)


def landmarks(rows: DataFrame, p: int, centre: np.ndarray, scale: np.ndarray, count: int, seed: int, rounds: int = 4) -> np.ndarray:
    """Up to ``count`` distinct rows (columns x0..), standardised, drawn in ``rounds``."""
    xs = [f"x{i}" for i in range(p)]
    u = F.xxhash64(F.lit(seed), *xs).cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    held = rows.select(*xs, u.alias("u"))
    chosen = np.zeros((0, p))
    for k in range(rounds):
        want = (count - len(chosen)) // (rounds - k)
        if not want:
            continue

        def draw(batches, chosen=chosen, want=want):
            best = np.zeros((0, p + 1))  # (draw, row), at most ``want`` distinct ones per task
            for b in batches:
                x = _matrix(b, p)
                far = _square_distances((x - centre) / scale, chosen).min(axis=1) if len(chosen) else np.ones(len(x))
                key = -np.log(np.clip(b.column(p).to_numpy(), 1e-18, 1 - 1e-16)) / np.maximum(far, 1e-300)
                best = np.unique(np.vstack([best, np.column_stack([key, x])[far > 1e-12]]), axis=0)[:want]
            yield pa.RecordBatch.from_arrays([pa.array(best[:, i]) for i in range(p + 1)], ["draw", *xs])

        got = (held.mapInArrow(draw, ", ".join(f"{n} double" for n in ["draw", *xs]))
               .groupBy(*xs).agg(F.min("draw").alias("draw")).orderBy("draw", *xs).limit(want).collect())
        chosen = np.vstack([chosen, *[(np.array([r[n] for n in xs]) - centre) / scale for r in got]])
    return chosen


def _sums(rows: DataFrame, model: KernelModel, w: np.ndarray, epsilon: float | None) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, gradient, curvature) of the squared losses at ``w``, without C and the penalty."""
    p, q = len(model.cols), len(w)

    def run(batches):
        total = np.zeros((q + 1, q + 1))
        for b in batches:
            z = model.features(_matrix(b, p))
            y, f = b.column(p).to_numpy(), z @ w
            if epsilon is None:
                sign = np.where(y > 0.5, 1.0, -1.0)
                r = 1 - sign * f
            else:
                sign, r = np.sign(y - f), np.abs(y - f) - epsilon
            on = r > 0
            v = np.column_stack([z[on], -sign[on] * r[on]])  # products: curvature, gradient, loss
            total += v.T @ v
        i, j = np.triu_indices(q + 1)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": total[i, j]})

    m = np.zeros((q + 1, q + 1))
    for r in rows.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    return m[q, q], 2 * m[:q, q], 2 * m[:q, :q]


def fit(df: DataFrame, cols: list[str], target: str, cost: float = 1.0, epsilon: float | None = None, gamma: float | str = "scale",
        count: int = 64, seed: int = 42, max_iter: int = 30, tol: float = 1e-7) -> KernelModel:
    """A classifier, or with ``epsilon`` a regression.  ``gamma="scale"`` is one over the number of columns, which are standardised."""
    p = len(cols)
    x = [c(v).cast("double") for v in [*cols, target]]
    rows = df.select(*[v.alias(f"x{i}") for i, v in enumerate(x)])
    for i in range(p + 1):
        rows = rows.where(F.col(f"x{i}").isNotNull() & ~F.isnan(f"x{i}"))
    first = rows.agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(p + 1) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    centre = np.array([first[f"m{i}"] or 0.0 for i in range(p)])
    scale = np.array([first[f"s{i}"] or 1.0 for i in range(p)])
    g = 1.0 / p if gamma == "scale" else float(gamma)
    marks = landmarks(rows, p, centre, scale, count, seed)
    values, vectors = np.linalg.eigh(_kernel(marks, marks, g)) if len(marks) else (np.zeros(0), np.zeros((0, 0)))
    use = values > 1e-10 * values.max(initial=0.0)
    model = KernelModel(tuple(cols), centre, scale, g, marks, vectors[:, use] / np.sqrt(values[use]), np.zeros(int(use.sum()) + 1))
    if not len(marks):
        return model
    w = model.weights
    if epsilon is not None:
        w[-1] = first[f"m{p}"]
    penalty = np.append(np.ones(len(w) - 1), 1e-9)

    def at(w):
        loss, grad, curve = _sums(rows, model, w, epsilon)
        return penalty @ (w * w) / 2 + cost * loss, penalty * w + cost * grad, np.diag(penalty) + cost * curve

    value, grad, curve = at(w)
    for _ in range(max_iter):
        step, t = -np.linalg.solve(curve + 1e-12 * np.eye(len(w)), grad), 1.0
        fall = -(grad @ step)
        if fall <= tol * max(abs(value), 1e-12):
            break
        while True:
            new = at(w + t * step)
            if new[0] <= value - 1e-4 * t * fall or t < 1e-4:
                break
            t /= 2
        if new[0] > value:
            break
        w, (value, grad, curve) = w + t * step, new
    return model._replace(weights=w)


def predict(df: DataFrame, model: KernelModel, name: str = "margin") -> DataFrame:
    """``df`` with the model's value (positive: class 1); null where a column is null or NaN."""
    @F.pandas_udf("double")
    def value(x: pd.DataFrame) -> pd.Series:
        raw = x.to_numpy(float, na_value=np.nan)
        out = model.value(raw)
        return pd.Series(np.where(np.isnan(raw).any(axis=1), np.nan, out))

    packed = F.struct(*[c(v).cast("double").alias(f"x{i}") for i, v in enumerate(model.cols)])
    return df.withColumn(name, F.nullif(value(packed), F.lit(float("nan"))))
