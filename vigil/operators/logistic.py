"""Logistic regressions over many feature sets and folds at once.

Every model minimises the mean log loss of the rows outside its fold plus
``1 / (2 n) |w|^2``, w being the weights of columns standardised on those rows
(the intercept is free): the optimum that ``plans.models.pipeline("logistic")``
seeks.  All models take their Newton steps together: one pass adds up losses,
gradients and curvatures, (columns + 1) squared numbers per model and task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.linear import moments
from vigil.operators.profile import c

TOLERANCE = 1e-11


def _design(batch: pa.RecordBatch, p: int, centre: np.ndarray, scale: np.ndarray):
    """(1, standardised columns), label, fold."""
    x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(p)]).astype(float)
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    return z, batch.column(p).to_numpy(zero_copy_only=False), batch.column(p + 1).to_numpy(zero_copy_only=False)


def _pass(rows: DataFrame, p: int, centre, scale, weights: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of losses (models), gradients (models, p + 1) and curvatures (models, p + 1, p + 1) outside each model's fold."""
    i, j = np.triu_indices(p + 1)
    models, width = len(skip), 1 + p + 1 + len(i)

    def run(batches):
        total = np.zeros((models, width))
        for b in batches:
            z, y, fold = _design(b, p, centre, scale)
            y, fold = y[:, None], fold[:, None]
            margin, use = z @ weights.T, fold != skip
            prob = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            loss = np.where(use, np.logaddexp(0, margin) - y * margin, 0.0).sum(axis=0)
            slope, curve = np.where(use, prob - y, 0.0), np.where(use, prob * (1 - prob), 0.0)
            total += np.column_stack((loss, slope.T @ z, curve.T @ (z[:, i] * z[:, j])))
        m, k = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"m": m.astype(np.int32), "k": k.astype(np.int32), "s": total[m, k]})

    total = np.zeros((models, width))
    for r in rows.mapInArrow(run, "m int, k int, s double").groupBy("m", "k").agg(F.sum("s").alias("s")).collect():
        total[r["m"], r["k"]] = r["s"]
    curve = np.zeros((models, p + 1, p + 1))
    curve[:, i, j] = curve[:, j, i] = total[:, p + 2:]
    return total[:, 0], total[:, 1:p + 2], curve


def fold_cells(df: DataFrame, sets: list[list[str]], folds: int, label: str = "label", fold: str = "fold", max_iter: int = 100) -> np.ndarray:
    """Confusion counts (set, fold, true class, predicted class) on each fold of the models of the other folds.
    A null, NaN or infinite value in a column is an error, as it is for the single fits."""
    cols = list(dict.fromkeys(f for s in sets for f in s))
    p = len(cols)
    rows = df.where(c(label).isNotNull()).select(*[c(x).cast("double").alias(f"x{i}") for i, x in enumerate(cols)], c(label).cast("double").alias("y"),
                                                 c(fold).cast("int").alias("fold"))
    odd = rows.where(" or ".join(f"x{i} is null or isnan(x{i}) or abs(x{i}) = double('infinity')" for i in range(p))).limit(1).count() if p else 0
    if odd:
        raise ValueError(f"null, NaN or infinite value in {cols}")
    mom = moments(df, cols, label, fold)
    centre, scale = mom.centre[:p], mom.scale[:p]
    skip = np.tile(np.arange(folds), len(sets))
    member = np.repeat(np.array([[True] + [x in s for x in cols] for s in sets]), folds, axis=0)
    n, penalty, weights, open_ = np.zeros(len(skip)), np.zeros(member.shape), np.zeros(member.shape), np.ones(len(skip), bool)
    for k, f in enumerate(skip.tolist()):
        m = mom.total(f)
        n[k] = m[0, 0]
        if not n[k]:
            open_[k] = False
            continue
        spread = m.diagonal()[1:p + 1] - m[0, 1:p + 1] ** 2 / n[k]
        penalty[k, 1:] = np.maximum(spread, 0.0) / max(n[k] - 1, 1)  # |w|^2 of the fold's own scale; summed losses, so 1/n becomes 1
        positive = m[0, p + 1] + n[k] * mom.centre[p]
        member[k, 1:] &= spread > 1e-12 * n[k]
        share = positive / n[k]
        if share < 0.5 / n[k] or share > 1 - 0.5 / n[k]:  # one class
            weights[k, 0], open_[k] = (-700.0 if share < 0.5 else 700.0), False
        else:
            weights[k, 0] = np.log(share / (1 - share))
    value, step = np.full(len(skip), np.inf), np.zeros(member.shape)
    for _ in range(max_iter if open_.any() else 0):
        at = np.flatnonzero(open_)
        loss, grad, curve = _pass(rows, p, centre, scale, weights[at], skip[at])
        loss = loss + (penalty[at] * weights[at] ** 2).sum(axis=1) / 2
        for k, m in enumerate(at.tolist()):
            if loss[k] > value[m] + 1e-12 * abs(value[m]):  # too far: half of the step
                step[m] /= 2
                weights[m] -= step[m]
                open_[m] = np.abs(step[m]).max() > 1e-12
                continue
            value[m], on = loss[k], np.flatnonzero(member[m])
            g = (grad[k] + penalty[m] * weights[m])[on]
            h = curve[k][np.ix_(on, on)] + np.diag(penalty[m][on] + 1e-12)
            step[m] = 0.0
            step[m, on] = -np.linalg.solve(h, g)
            weights[m] += step[m]
            open_[m] = -(g @ step[m, on]) > TOLERANCE * max(abs(value[m]), 1e-300)
        if not open_.any():
            break

    def count(batches):
        cells = np.zeros((len(skip), 4), np.int64)
        for b in batches:
            z, y, held = _design(b, p, centre, scale)
            for f in range(folds):
                mine = held == f
                yes = z[mine] @ weights[skip == f].T > 0
                cell = 2 * y[mine, None].astype(int) + yes
                for k, m in enumerate(np.flatnonzero(skip == f)):
                    cells[m] += np.bincount(cell[:, k], minlength=4)
        m, k = np.nonzero(cells)
        yield pa.RecordBatch.from_pydict({"m": m.astype(np.int32), "k": k.astype(np.int32), "n": cells[m, k]})

    out = np.zeros((len(skip), 4), np.int64)
    for r in rows.mapInArrow(count, "m int, k int, n long").groupBy("m", "k").agg(F.sum("n").alias("n")).collect():
        out[r["m"], r["k"]] = r["n"]
    return out.reshape(len(sets), folds, 2, 2)
