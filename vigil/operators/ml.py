"""Model training, search, selection loops and model-based operators.

Loops over candidates / folds / feature subsets run on the driver; every fit,
score and metric runs on Spark over the (cached) assembled frame, and only
metric or importance rows come back.  Folds are the deterministic stratified
``fold`` column (D2), fed to ``CrossValidator(foldCol=...)``.
"""

from __future__ import annotations

import itertools
import math
import random
import time

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import evaluation as V
from vigil.operators import forest as FO
from vigil.operators import logistic as LG
from vigil.plans import models as M
from vigil.functions.cache import fewer_tasks, keep


def scored_from(pred: DataFrame, key: str = "key", label: str = "label") -> DataFrame:
    """Model output -> the scored table ``key, y, yhat, p`` (p = class-1 probability,
    or the prediction itself when the model has no probability)."""
    p = vector_to_array("probability")[1] if "probability" in pred.columns else F.col("prediction")
    return pred.select(key, F.col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("yhat"),
                       p.cast("double").alias("p"))


def metrics_row(scored: DataFrame, auc: bool = True) -> dict:
    """Accuracy, weighted P / R / F1, F1 of the positive class (one aggregate) and AUC (one more) of a scored table."""
    cells = V.binary_cells(scored)
    m = V.class_metrics(cells).select("accuracy", "precision", "recall", "f1", "f1_1").first().asDict()
    if auc:
        m["auc"] = V.roc_auc(scored).first()["auc"]
    return m


def fit_evaluate(pipe: Pipeline, train: DataFrame, test: DataFrame, key: str = "key", label: str = "label",
                 auc: bool = True) -> tuple:
    t0 = time.time()
    model = pipe.fit(train)
    fit_s = time.time() - t0
    t0 = time.time()
    m = metrics_row(scored_from(model.transform(test), key, label), auc)
    m["training_time"] = fit_s
    m["prediction_time"] = time.time() - t0
    return model, m


def fold_sizes(df: DataFrame) -> dict[int, int]:
    """Rows per fold."""
    return {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}


def cross_validate(make_pipe, df: DataFrame, k: int, key: str = "key", label: str = "label",
                   metric: str = "accuracy") -> dict:
    """Per-fold score of the model fitted on the other folds; mean, population std, min, max.
    ``make_pipe(n)`` gets the training rows of the fold (penalties depend on them)."""
    size = fold_sizes(df)
    total, scores = sum(size.values()), []
    for f in range(k):
        _, m = fit_evaluate(make_pipe(total - size.get(f, 0)), df.where(F.col("fold") != f), df.where(F.col("fold") == f), key, label,
                            auc=metric == "auc")
        scores.append(m[metric])
    a = np.array(scores, dtype=float)
    return {"scores": scores, "mean": float(a.mean()), "std": float(a.std()), "min": float(a.min()), "max": float(a.max())}


def grid_search(pipe: Pipeline, grid: list, df: DataFrame, label: str = "label", metric: str = "f1",
                parallelism: int = 2):
    """T4: every parameter combination scored over the fold column (weighted F1)."""
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    return cross_validator(pipe, grid, ev, df, parallelism).fit(df)


def cross_validator(pipe, grid, evaluator, df: DataFrame, parallelism: int = 2) -> CrossValidator:
    """A ``CrossValidator`` over the folds that ``df`` has."""
    return CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=evaluator, numFolds=len(fold_sizes(df)), foldCol="fold",
                          parallelism=parallelism, collectSubModels=False)


def sample_grid(grid: list, n_iter: int, seed: int = 42) -> list:
    """T5: seeded sample of the parameter maps (random search)."""
    rnd = random.Random(seed)
    return grid if n_iter >= len(grid) else rnd.sample(grid, n_iter)


def importances(model: PipelineModel, cols: list[str]) -> list[tuple[str, float]]:
    """Tree importances, or mean |coefficient| for linear models."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray()
    elif hasattr(last, "coefficientMatrix"):
        vals = np.abs(last.coefficientMatrix.toArray()).mean(axis=0)
    elif hasattr(last, "coefficients"):
        vals = np.abs(last.coefficients.toArray())
    else:
        raise ValueError("model has no importances")
    return sorted(zip(cols, [float(v) for v in vals]), key=lambda t: (-t[1], t[0]))


def _forest(cols, label, trees, depth, seed):
    return M.pipeline("random_forest", cols, label, n_estimators=trees, max_depth=depth, seed=seed)


def _weakest(imp: list[tuple[str, float]], n: int) -> list[str]:
    return [f for f, _ in sorted(imp, key=lambda t: (t[1], t[0]))[:n]]


def rfe(df: DataFrame, cols: list[str], n_select: int, label: str = "label", trees: int = 100, step: int = 1,
        seed: int = 42, depth: int = 6) -> list[tuple[str, int]]:
    """Refit a random forest, drop the weakest feature(s), repeat down to n; ranking 1 = kept."""
    remaining, dropped = list(cols), []
    while len(remaining) > n_select:
        imp = importances(_forest(remaining, label, trees, depth, seed).fit(df), remaining)
        dropped.append(_weakest(imp, min(step, len(remaining) - n_select)))
        remaining = [f for f in remaining if f not in dropped[-1]]
    ranking = dict.fromkeys(remaining, 1) | {f: r for r, out in enumerate(reversed(dropped), 2) for f in out}
    return sorted(ranking.items(), key=lambda t: (t[1], t[0]))


def rfecv(df: DataFrame, cols: list[str], k: int = 5, step: int = 1, min_features: int = 1, label: str = "label", key: str = "key",
          trees: int = 100, seed: int = 42, depth: int = 6, metric: str = "f1_1") -> tuple[list[str], list[dict]]:
    """Elimination inside each fold, every size scored on the held-out fold;
    the size with the best mean (the smallest on ties) is refitted on all rows.
    Returns (selected features, one row per size)."""
    scores: dict[int, list[float]] = {}
    for f in range(k):
        train, held, remaining = df.where(F.col("fold") != f), df.where(F.col("fold") == f), list(cols)
        while True:
            model, m = fit_evaluate(_forest(remaining, label, trees, depth, seed), train, held, key, label, auc=False)
            scores.setdefault(len(remaining), []).append(m[metric])
            if len(remaining) <= min_features:
                break
            out = _weakest(importances(model, remaining), min(step, len(remaining) - min_features))
            remaining = [c for c in remaining if c not in out]
    rows = [{"size": n, "f1": float(np.mean(v)), "f1_std": float(np.std(v))} for n, v in sorted(scores.items())]
    best = max(rows, key=lambda r: (r["f1"], -r["size"]))["size"]
    return [f for f, r in rfe(df, cols, best, label, trees, step, seed, depth) if r == 1], rows


def sequential(df: DataFrame, cols: list[str], n_select: int, k: int = 5, direction: str = "forward", label: str = "label",
               metric: str = "f1_1", max_iter: int = 100) -> list[tuple[str, float]]:
    """Greedy selection by mean fold F1 of a logistic model; forward: the
    features in the order they were added; backward: the features in the order
    they were removed, down to ``n_select``.  Ties go to the first name."""
    if direction not in ("forward", "backward"):
        raise ValueError(f"unknown direction {direction!r}")
    forward, chosen, path = direction == "forward", [], []
    n, top = df.agg(F.count(F.lit(1)), F.max(F.col(label))).first()
    together = metric in ("accuracy", "f1", "f1_1") and (top is None or top <= 1)  # two classes, scores of the confusion counts
    few = fewer_tasks(df, n)
    while len(chosen) < (n_select if forward else len(cols) - n_select):
        rest = [c for c in cols if c not in chosen]
        sets = [[*chosen, cand] if forward else [c for c in rest if c != cand] for cand in rest]
        if together:
            cells = LG.fold_cells(few, sets, k, label, max_iter=max_iter)
            means = [float(np.mean([FO.metrics(c)[metric] for c in mine])) for mine in cells]
        else:
            means = [cross_validate(lambda n, f=feats: M.pipeline("logistic", f, label, n_rows=n, max_iter=max_iter), df, k, label=label,
                                    metric=metric)["mean"] for feats in sets]
        scored = [(-m, cand) for m, cand in zip(means, rest)]
        s, cand = min(scored)
        chosen.append(cand)
        path.append((cand, -s))
    return path


# ---------------------------------------------------------------- V14 bootstrap
def bootstrap_ci(cells: DataFrame, n_boot: int = 1000, seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """Resampling rows with replacement = a multinomial draw over the four
    confusion cells (same distribution), so each replicate is four numbers.
    Replicates are generated in parallel (range x mapInPandas, seeded per
    replicate); single-class replicates are skipped; percentile intervals."""
    spark = cells.sparkSession
    c = cells.first()
    counts = np.array([c["tn"], c["fp"], c["fn"], c["tp"]], dtype=np.int64)
    n = int(counts.sum())
    probs = (counts / n).tolist() if n else [0.25] * 4

    def draw(it):
        for pdf in it:
            rows = []
            for b in pdf["id"].tolist():
                rng = np.random.default_rng([seed, int(b)])
                tn, fp, fn, tp = rng.multinomial(n, probs)
                if (tn + fp) == 0 or (fn + tp) == 0:
                    continue
                acc = (tp + tn) / n
                p1 = tp / (tp + fp) if tp + fp else 0.0
                r1 = tp / (tp + fn) if tp + fn else 0.0
                p0 = tn / (tn + fn) if tn + fn else 0.0
                r0 = tn / (tn + fp) if tn + fp else 0.0
                f1_1 = 2 * p1 * r1 / (p1 + r1) if p1 + r1 else 0.0
                f1_0 = 2 * p0 * r0 / (p0 + r0) if p0 + r0 else 0.0
                s1, s0 = tp + fn, tn + fp
                rows.append((int(b), acc, (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f1_0 * s0 + f1_1 * s1) / n))
            yield pd.DataFrame(rows, columns=["replicate", "accuracy", "precision", "recall", "f1"])

    reps = spark.range(n_boot).mapInPandas(draw, "replicate long, accuracy double, precision double, recall double, f1 double")
    lo, hi = alpha / 2, 1 - alpha / 2
    aggs = [F.count(F.lit(1)).alias("replicates")]
    for m in ("accuracy", "precision", "recall", "f1"):
        aggs += [F.percentile(m, lo).alias(f"{m}_lo"), F.percentile(m, hi).alias(f"{m}_hi")]
    return reps.agg(*aggs)


# ---------------------------------------------------------------- J6 / G11 nearest neighbours
KNN_BROADCAST_BYTES = 64 << 20  # training vectors up to this size go to every task
KNN_CELLS = 1 << 22  # query x training x dimension values in one distance buffer (32 MB)


def _closest(q: np.ndarray, t: np.ndarray, k: int, barred: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, training) numbers, ascending, of all pairs that can be among a query's
    ``k`` nearest or tie with them after rounding to 9 decimals.  Squared distances
    come from one matrix product; what they can be off by is added to the k-th of a query."""
    centre = t.mean(axis=0)  # far from the origin the product would lose digits
    q, t = q - centre, t - centre
    a, b = (q * q).sum(axis=1), (t * t).sum(axis=1)
    d = a[:, None] + b - 2 * (q @ t.T)
    if barred is not None:
        d[barred] = np.inf
    kth = np.partition(d, k - 1, axis=1)[:, k - 1]
    off = 8 * (q.shape[1] + 8) * np.finfo(float).eps * (a + b.max(initial=0.0))
    reach = (np.sqrt(np.maximum(kth, 0.0) + off) + 2e-9) ** 2 * (1 + 1e-12) + off
    near = (d <= reach[:, None]) | np.isnan(d)
    if barred is not None:
        near &= ~barred
    return np.nonzero(near)


def knn(queries: DataFrame, train: DataFrame, qid: str, tid: str, vec: str, label: str, k: int = 5,
        exclude_self: bool = False, weights: str = "uniform", p: float = 2.0, task: str = "classify",
        block_rows: int = 50_000) -> DataFrame:
    """Exact k nearest neighbours by Minkowski distance (ties by training id).

    Training vectors within ``KNN_BROADCAST_BYTES`` (rows x dimension, checked):
    broadcast as a matrix; query batches compute distances block-wise in numpy
    and keep only the k best per query.  Larger training sides: training rows
    and queries are hashed into blocks of about ``block_rows``; each query is
    sent to every block (an equi-join on the block id), each task keeps its k
    best, and a final grouped merge keeps k.  Distance buffers are bounded by
    ``KNN_CELLS`` whatever the dimension.
    """
    spark = queries.sparkSession
    n_train, dim = train.agg(F.count(F.lit(1)), F.max(F.size(vec))).first()
    dim = max(int(dim or 1), 1)
    schema = "qid long, nid long, dist double, nlabel double"

    def topk(qids, qv, tids, tv, tl):
        out = []
        wide = max(k + 1, KNN_CELLS // dim)  # training rows at a time
        row = dim if p != 2.0 else 1  # numbers of a pair in the buffer
        step = max(1, KNN_CELLS // (row * min(wide, max(len(tids), 1))))
        for s in range(0, len(qids), step):
            e = s + step
            qb, qi = qv[s:e], qids[s:e]
            best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0))] * len(qb)
            for t in range(0, len(tids), wide):
                if p == 2.0 and len(tids[t:t + wide]) > 4 * k:
                    cand_i, cand_t = _closest(qb, tv[t:t + wide], k, qi[:, None] == tids[None, t:t + wide] if exclude_self else None)
                    dist = np.round(np.sqrt((np.abs(qb[cand_i] - tv[t + cand_t]) ** 2).sum(-1)), 9)
                    bounds = np.searchsorted(cand_i, np.arange(len(qb) + 1))
                    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                        at = t + cand_t[lo:hi]
                        d, ids, lab = (np.concatenate(x) for x in zip(best[i], (dist[lo:hi], tids[at], tl[at])))
                        order = np.lexsort((ids, d))[:k]
                        best[i] = d[order], ids[order], lab[order]
                    continue
                diff = np.abs(qb[:, None, :] - tv[None, t:t + wide, :])
                d = np.round(np.sqrt((diff ** 2).sum(-1)) if p == 2.0 else (diff ** p).sum(-1) ** (1.0 / p), 9)
                if exclude_self:
                    d[qi[:, None] == tids[None, t:t + wide]] = np.inf
                for i, di in enumerate(d):
                    n = min(k, len(di))
                    near = np.flatnonzero(di <= np.partition(di, n - 1)[n - 1])  # ties included
                    near = near[np.isfinite(di[near])]
                    dist, ids, lab = (np.concatenate(x) for x in zip(best[i], (di[near], tids[t + near], tl[t + near])))
                    order = np.lexsort((ids, dist))[:k]
                    best[i] = dist[order], ids[order], lab[order]
            out += [(int(q), int(j), float(x), float(lb)) for q, b in zip(qi, best) for x, j, lb in zip(*b)]
        return out

    if n_train * dim * 8 <= KNN_BROADCAST_BYTES:
        tr = train.select(tid, vec, label).toPandas()
        bc = spark.sparkContext.broadcast((tr[tid].to_numpy(np.int64), np.stack(tr[vec].to_numpy()).astype(np.float64),
                                           tr[label].to_numpy(np.float64)))

        def run(it):
            tids, tv, tl = bc.value
            for pdf in it:
                if len(pdf) == 0:
                    continue
                qv = np.stack(pdf[vec].to_numpy()).astype(np.float64)
                yield pd.DataFrame(topk(pdf[qid].to_numpy(np.int64), qv, tids, tv, tl),
                                   columns=["qid", "nid", "dist", "nlabel"])

        nb = queries.select(qid, vec).mapInPandas(run, schema)
    else:
        qblocks = max(1, math.ceil(queries.count() / block_rows))
        blocks = max(1, math.ceil(n_train / block_rows))
        tb = train.select(F.col(tid).alias("_tid"), F.col(vec).alias("_tv"), F.col(label).cast("double").alias("_tl"),
                          F.pmod(F.xxhash64(tid), F.lit(blocks)).alias("tblk"),
                          F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))).alias("qblk"))
        qb = queries.select(F.col(qid).alias("_qid"), F.col(vec).alias("_qv"),
                            F.pmod(F.xxhash64(qid), F.lit(qblocks)).alias("qblk"),
                            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("tblk"))

        def run_block(q, t):
            if len(q) == 0 or len(t) == 0:
                return pd.DataFrame({"qid": pd.Series([], "int64"), "nid": pd.Series([], "int64"),
                                     "dist": pd.Series([], "float64"), "nlabel": pd.Series([], "float64")})
            return pd.DataFrame(topk(q["_qid"].to_numpy(np.int64), np.stack(q["_qv"].to_numpy()).astype(np.float64),
                                     t["_tid"].to_numpy(np.int64), np.stack(t["_tv"].to_numpy()).astype(np.float64),
                                     t["_tl"].to_numpy(np.float64)), columns=["qid", "nid", "dist", "nlabel"])

        # block nested loop: each (query block, training block) task sees its two slices as
        # pandas frames (cogroup - no pair rows are materialised) and keeps k per query
        part = qb.groupBy("qblk", "tblk").cogroup(tb.groupBy("qblk", "tblk")).applyInPandas(run_block, schema)
        from pyspark.sql.window import Window
        w = Window.partitionBy("qid").orderBy("dist", "nid")
        nb = part.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
    w8 = F.when(F.col("dist") == 0, F.lit(1e12)).otherwise(1.0 / F.col("dist")) if weights == "distance" else F.lit(1.0)
    if task == "regress":
        return nb.groupBy("qid").agg((F.sum(w8 * F.col("nlabel")) / F.sum(w8)).alias("prediction"))
    votes = nb.groupBy("qid", "nlabel").agg(F.sum(w8).alias("_v"))
    best = F.max_by("nlabel", F.struct(F.col("_v"), F.negative(F.col("nlabel"))))
    return votes.groupBy("qid").agg(best.cast("int").alias("prediction"))


# ---------------------------------------------------------------- G13 / G14 reconstruction
def fit_reconstruction(df: DataFrame, cols: list[str], k: int = 2, contamination: float = 0.05):
    """PCA(k) on standardised input; error = |x|^2 - |P'x|^2 (the squared
    distance to the k-dim subspace); threshold = the (1 - contamination) quantile."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
                            PCA(k=k, inputCol="scaled", outputCol="latent")])
    model = pipe.fit(df)
    err = reconstruction_error(model.transform(df))
    from vigil.functions.ordering import fit_quantiles

    thr = fit_quantiles(err, ["recon_error"], [1 - contamination])["recon_error"][0]
    return model, thr


def reconstruction_error(t: DataFrame) -> DataFrame:
    x, z = vector_to_array("scaled"), vector_to_array("latent")
    sq = lambda a: F.aggregate(F.transform(a, lambda v: v * v), F.lit(0.0), lambda acc, v: acc + v)
    return t.withColumn("recon_error", F.greatest(sq(x) - sq(z), F.lit(0.0)))


def anomaly_scores(model: PipelineModel, thr: float, df: DataFrame) -> DataFrame:
    t = reconstruction_error(model.transform(df))
    return t.withColumns({"anomaly": (F.col("recon_error") > thr).cast("int"),
                          "anomaly_score": F.least(F.greatest(F.col("recon_error") / (2 * thr), F.lit(0.0)), F.lit(1.0))})


def persist(df: DataFrame) -> DataFrame:
    return keep(df)
