"""Evaluation of scored tables (V1-V25) and model comparison.

Input: a scored table ``key, y, yhat, p`` with optional group columns (e.g.
``model_name``), so every metric of every model runs in one pass with the
model as an extra group key.  Classification metrics need only the
confusion cells (one ``groupBy(y, yhat)``); curve metrics need only one
``groupBy(p)`` plus distributed prefix sums over the distinct scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.functions.ordering import exact_quantiles_distributed, grouped_prefix, null_safe_join
from vigil.operators.profile import quantiles
from vigil.functions.cache import keep

# Cost constants of the three business models and metric bands.
COST_A = {"failure": 10000, "maintenance": 1000, "false_positive": 500, "false_negative": 8000}
COST_B = {"failure": 10000, "maintenance": 1000, "production_value_per_hour": 5000, "maintenance_hours": 4}
COST_C = {"tp": -100, "tn": -10, "fp": 500, "fn": 5000}
BANDS = {
    "accuracy": (0.95, 0.85, 0.75),
    "precision": (0.9, 0.8, 0.7),
    "recall": (0.9, 0.8, 0.7),
    "f1": (0.9, 0.8, 0.7),
    "auc": (0.95, 0.85, 0.75),
}
GATES = {"accuracy": 0.85, "precision": 0.80, "recall": 0.85, "f1": 0.82}
GATE_WEIGHTS = {"accuracy": 0.2, "precision": 0.3, "recall": 0.3, "f1": 0.2}
LOWER_IS_BETTER = ("rmse", "mae", "mape", "mse", "brier")
# Recommendation texts of the readiness check.
RECOMMENDATIONS = {
    "accuracy": "Improve overall accuracy through better feature engineering or model tuning",
    "precision": "Reduce false positives to minimize unnecessary maintenance costs",
    "recall": "Improve failure detection to reduce missed critical failures",
    "f1": "Balance precision and recall for optimal F1-score",
    "roi": "Business ROI below target - consider cost-benefit optimization",
    "ok": "Model performance meets production standards - ready for deployment",
}


def _div(a: Column, b: Column, zero: float | None = 0.0) -> Column:
    """a / b with 0/0 (and x/0) -> ``zero``."""
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return q if zero is None else F.coalesce(q, F.lit(zero))


# ---------------------------------------------------------------- V1 / V2
def binary_cells(scored: DataFrame, by: list[str] | None = None, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """tn, fp, fn, tp (and n) per group from one aggregate (zeros included)."""
    by = by or []
    aggs = [F.count_if((F.col(y) == 0) & (F.col(yhat) == 0)).alias("tn"),
            F.count_if((F.col(y) == 0) & (F.col(yhat) == 1)).alias("fp"),
            F.count_if((F.col(y) == 1) & (F.col(yhat) == 0)).alias("fn"),
            F.count_if((F.col(y) == 1) & (F.col(yhat) == 1)).alias("tp"),
            F.count(F.lit(1)).alias("n")]
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def confusion_matrix(scored: DataFrame, by: list[str] | None = None, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """V1: long (y, yhat, count) with the zero cells present."""
    by = by or []
    cells = binary_cells(scored, by, y, yhat)
    st = "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (y, yhat, count)"
    return cells.selectExpr(*by, st)


def class_metrics(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """V2: accuracy; per-class and support-weighted precision, recall, F1 (0/0 -> 0)."""
    by = by or []
    tn, fp, fn, tp, n = (F.col(x) for x in ("tn", "fp", "fn", "tp", "n"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_1, f1_0 = _div(2 * p1 * r1, p1 + r1), _div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    w = lambda a, b: _div(a * s0 + b * s1, n)
    return cells.select(*by, _div(tp + tn, n).alias("accuracy"),
                        w(p0, p1).alias("precision"), w(r0, r1).alias("recall"), w(f1_0, f1_1).alias("f1"),
                        p0.alias("precision_0"), r0.alias("recall_0"), f1_0.alias("f1_0"), s0.alias("support_0"),
                        p1.alias("precision_1"), r1.alias("recall_1"), f1_1.alias("f1_1"), s1.alias("support_1"))


# ---------------------------------------------------------------- any number of classes
def confusion_long(scored: DataFrame, by: list[str] | None = None, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """V1 for any classes: (y, yhat, count) of the pairs that occur, one aggregate; nulls are a class."""
    return scored.groupBy(*(by or []), F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("count"))


def class_report(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """V2 for any classes, from ``confusion_long``: per class precision, recall,
    F1 and support (0/0 -> 0); every class of either side has a row."""
    by = by or []
    side = lambda c, hit, truth, said: cells.select(*by, F.col(c).alias("class"), hit.alias("tp"), truth.alias("t"), said.alias("s"))
    n, zero = F.col("count"), F.lit(0).cast("long")
    equal = F.when(F.col("y").eqNullSafe(F.col("yhat")), n).otherwise(zero)
    both = side("y", equal, n, zero).unionByName(side("yhat", zero, zero, n))
    g = both.groupBy(*by, "class").agg(F.sum("tp").alias("tp"), F.sum("t").alias("support"), F.sum("s").alias("said"))
    p, r = _div(F.col("tp"), F.col("said")), _div(F.col("tp"), F.col("support"))
    return g.select(*by, "class", p.alias("precision"), r.alias("recall"), _div(2 * p * r, p + r).alias("f1"), "support", "tp")


def class_summary(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, macro and support-weighted precision, recall and F1 of a ``class_report``."""
    n = F.sum("support")
    aggs = [_div(F.sum("tp"), n).alias("accuracy")]
    for m in ("precision", "recall", "f1"):
        aggs += [F.avg(m).alias(f"macro_{m}"), _div(F.sum(F.col(m) * F.col("support")), n).alias(f"weighted_{m}")]
    return report.groupBy(*(by or [])).agg(*aggs)


def roc_auc_ovr(scored: DataFrame, scores: dict, y: str = "y") -> DataFrame:
    """V3 for any classes: one-vs-rest AUC per class; ``scores`` maps a class to
    its score column.  One unpivot, then the grouped binary AUC."""
    rows = F.array(*[F.struct(F.lit(k).alias("class"), F.when(F.col(y) == F.lit(k), 1).otherwise(0).alias("y"), F.col(c).alias("p"))
                     for k, c in scores.items()])
    return roc_auc(scored.select(F.inline(rows)), ["class"])


# ---------------------------------------------------------------- curves
def score_counts(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """One row per (group, distinct score): positives and negatives (cached: the
    curve operators read it several times and it is far smaller than the input)."""
    by = by or []
    return scored.groupBy(*by, F.col(p).alias("p")).agg(F.count_if(F.col(y) == 1).alias("pos"),
                                                        F.count_if(F.col(y) != 1).alias("neg")).transform(keep)


def _totals(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")) if by else \
        counts.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def _attach_totals(df: DataFrame, tot: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return null_safe_join(df, tot, by)
    row = tot.first()
    return df.withColumns({"n_pos": F.lit(row["n_pos"]).cast("long"), "n_neg": F.lit(row["n_neg"]).cast("long")})


def roc_auc(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """V3: tie-aware AUC = sum pos_i (neg below + neg_i / 2) / (P N)."""
    by = by or []
    cnt = score_counts(scored, by, y, p)
    pre = grouped_prefix(cnt, by, ["p"], ["neg"])
    part = pre.select(*by, (F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("_a"), "pos", "neg")
    g = part.groupBy(*by) if by else part.groupBy()
    return g.agg(_div(F.sum("_a"), F.sum("pos") * F.sum("neg"), None).alias("auc"))


def cumulative_from_top(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """Per (group, distinct threshold t): tp / fp of the rule p >= t, plus P and N."""
    by = by or []
    cnt = score_counts(scored, by, y, p)
    pre = grouped_prefix(cnt, by, ["p"], ["pos", "neg"], descending=True)
    pre = pre.withColumns({"tp": F.col("pos_before") + F.col("pos"), "fp": F.col("neg_before") + F.col("neg")})
    return _attach_totals(pre, _totals(cnt, by), by)


def _end_points(c: DataFrame, by: list[str], cols: dict) -> DataFrame:
    """One extra curve point per group (the groups come from the small per-score table)."""
    if by:
        base = c.select(*by).distinct()
    else:
        base = c.sparkSession.range(1).select()
    return base.select(*by, F.lit(None).cast("double").alias("threshold"),
                       *[F.lit(v).alias(k) for k, v in cols.items()])


def roc_curve(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """V4: (threshold, fpr, tpr) per distinct threshold, plus the origin (threshold NULL)."""
    by = by or []
    c = cumulative_from_top(scored, by, y, p)
    pts = c.select(*by, F.col("p").alias("threshold"), _div(F.col("fp"), F.col("n_neg"), None).alias("fpr"),
                   _div(F.col("tp"), F.col("n_pos"), None).alias("tpr"))
    return pts.unionByName(_end_points(c, by, {"fpr": 0.0, "tpr": 0.0}))


def pr_curve(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """V5: (threshold, precision, recall) per distinct threshold plus the final (1, 0) point."""
    by = by or []
    c = cumulative_from_top(scored, by, y, p)
    pts = c.select(*by, F.col("p").alias("threshold"), _div(F.col("tp"), F.col("tp") + F.col("fp"), None).alias("precision"),
                   _div(F.col("tp"), F.col("n_pos"), None).alias("recall"))
    return pts.unionByName(_end_points(c, by, {"precision": 1.0, "recall": 0.0}))


def average_precision(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """V6: sum over thresholds (descending) of (R_n - R_{n-1}) P_n = sum pos_n / P * precision_n."""
    by = by or []
    c = cumulative_from_top(scored, by, y, p)
    term = _div(F.col("pos"), F.col("n_pos"), None) * _div(F.col("tp"), F.col("tp") + F.col("fp"), None)
    g = c.groupBy(*by) if by else c.groupBy()
    return g.agg(F.sum(term).alias("average_precision"))


def best_threshold(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """V7: threshold with the largest F1 of the rule p >= t (undefined F1 skipped;
    ties -> the higher threshold), with accuracy / precision / recall there."""
    by = by or []
    c = cumulative_from_top(scored, by, y, p)
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"), None)
    rec = _div(F.col("tp"), F.col("n_pos"), None)
    f1 = F.try_divide(2 * prec * rec, prec + rec)
    acc = _div(F.col("tp") + F.col("n_neg") - F.col("fp"), F.col("n_pos") + F.col("n_neg"), None)
    c = c.select(*by, F.col("p").alias("threshold"), f1.alias("f1"), acc.alias("accuracy"), prec.alias("precision"),
                 rec.alias("recall")).where(F.col("f1").isNotNull())
    best = F.max_by(F.struct("threshold", "f1", "accuracy", "precision", "recall"), F.struct("f1", "threshold"))
    g = c.groupBy(*by) if by else c.groupBy()
    return g.agg(best.alias("b")).select(*by, "b.*")


def calibration(scored: DataFrame, by: list[str] | None = None, n_bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    """V8: uniform bins of p: mean p, positive share, count (empty bins absent)."""
    by = by or []
    b = F.least(F.floor(F.col(p) * n_bins), F.lit(n_bins - 1)).cast("int")
    return scored.groupBy(*by, b.alias("bin")).agg(F.avg(p).alias("mean_predicted"),
                                                   F.avg(F.col(y).cast("double")).alias("fraction_positive"),
                                                   F.count(F.lit(1)).alias("count"))


def brier(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """V9: mean (p - y)^2."""
    by = by or []
    e = F.avg((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("brier")
    return scored.groupBy(*by).agg(e) if by else scored.agg(e)


# ---------------------------------------------------------------- regression
def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: list[str] | None = None,
                       method: str = "exact") -> DataFrame:
    """Mse, rmse, mae, r2, mape (zero truth -> NULL term), residual std
    (population), median / p75 / p90 / p95 / max absolute error."""
    by = by or []
    r = F.col(y) - F.col(yhat)
    ae = F.abs(r)
    probs = [0.5, 0.75, 0.9, 0.95]
    aggs = [F.avg(r * r).alias("mse"), F.avg(ae).alias("mae"), F.sum(r * r).alias("_sse"),
            (F.var_pop(F.col(y)) * F.count(F.when(r.isNotNull(), F.col(y)))).alias("_sst"),
            (F.avg(F.abs(F.try_divide(r, F.col(y)))) * 100).alias("mape"), F.stddev_pop(r).alias("residual_std"),
            F.max(ae).alias("max_error")]
    if method == "approx":
        aggs.append(quantiles(ae, probs, method).alias("_q"))
    g = (df.groupBy(*by) if by else df.groupBy()).agg(*aggs)
    if method != "approx":  # exact, by counted values: no task holds all errors
        long = exact_quantiles_distributed(df.select(*by, ae.alias("_ae")), "_ae", probs, by)
        q = (long.groupBy(*by) if by else long.groupBy()).agg(
            F.array(*[F.max(F.when(F.col("prob") == x, F.col("value"))) for x in probs]).alias("_q"))
        g = null_safe_join(g, q, by, "left") if by else g.withColumn("_q", F.lit(q.first()["_q"]))
    return g.select(*by, "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"),
                    "mape", "residual_std", F.col("_q")[0].alias("median_ae"), F.col("_q")[1].alias("p75_ae"),
                    F.col("_q")[2].alias("p90_ae"), F.col("_q")[3].alias("p95_ae"), "max_error")


# ---------------------------------------------------------------- cost models
def cost_failure_model(cells: DataFrame, by: list[str] | None = None, c: dict = COST_A) -> DataFrame:
    """cost = fp c_fp + fn c_fn + (tp + fp) c_maint; value = tp c_fail - cost;
    roi = value / cost * 100 (NULL when cost is 0); savings = failures c_fail - cost."""
    by = by or []
    cost = F.col("fp") * c["false_positive"] + F.col("fn") * c["false_negative"] + (F.col("tp") + F.col("fp")) * c["maintenance"]
    value = F.col("tp") * c["failure"] - cost
    return cells.select(*by, cost.alias("total_cost"), value.alias("total_value"),
                        F.try_divide(value * 100.0, cost).alias("roi"),
                        ((F.col("tp") + F.col("fn")) * c["failure"] - cost).alias("cost_savings"))


def cost_downtime_model(cells: DataFrame, by: list[str] | None = None, c: dict = COST_B) -> DataFrame:
    """Missed failures + unnecessary maintenance + production loss; the
    baseline charges every row as a failure (as defined by the source)."""
    by = by or []
    missed = F.col("fn") * c["failure"]
    unnecessary = F.col("fp") * c["maintenance"]
    loss = (F.col("tp") + F.col("fp")) * c["maintenance_hours"] * c["production_value_per_hour"]
    total = missed + unnecessary + loss
    base = F.col("n") * c["failure"]
    pct = F.when(base > 0, (base - total) * 100.0 / base).otherwise(F.lit(0.0))
    return cells.select(*by, missed.alias("cost_missed_failures"), unnecessary.alias("cost_unnecessary_maintenance"),
                        loss.alias("production_loss"), total.alias("total_cost"), (base - total).alias("cost_savings"),
                        pct.alias("cost_savings_percentage"), pct.alias("roi_percentage"), base.alias("baseline_cost"))


def cost_matrix_model(cells: DataFrame, by: list[str] | None = None, m: dict = COST_C) -> DataFrame:
    """Sum of cells x matrix; reactive = all rows x fn cost; detection and false alarm rates."""
    by = by or []
    total = F.col("tp") * m["tp"] + F.col("tn") * m["tn"] + F.col("fp") * m["fp"] + F.col("fn") * m["fn"]
    reactive = F.col("n") * m["fn"]
    return cells.select(*by, total.alias("total_cost"), reactive.alias("reactive_cost"), (reactive - total).alias("savings"),
                        _div((reactive - total) * 100, F.abs(reactive)).alias("roi"),
                        _div(F.col("tp"), F.col("tp") + F.col("fn")).alias("detection_rate"),
                        _div(F.col("fp"), F.col("fp") + F.col("tn")).alias("false_alarm_rate"),
                        _div(total, F.col("n")).alias("cost_per_prediction"))


# ---------------------------------------------------------------- V25 many models
def evaluate_many(scored: DataFrame, model: str = "model_name") -> DataFrame:
    """One metrics row per model (accuracy, weighted precision / recall / F1,
    AUC, Brier, cost-model value and ROI); each metric is one grouped aggregate
    with the model as a key, joined on the model (small, one row per model)."""
    by = [model]
    cells = binary_cells(scored, by)
    m = class_metrics(cells, by).select(model, "accuracy", "precision", "recall", "f1")
    auc = roc_auc(scored, by)
    b = brier(scored, by)
    cost = cost_failure_model(cells, by).select(model, F.col("total_value").alias("business_value"), "roi")
    return m.join(auc, model).join(b, model).join(cost, model)


# ---------------------------------------------------------------- model tables (small: one row per model)
def long_metrics(metrics: DataFrame, names: list[str], model: str = "model_name") -> DataFrame:
    st = f"stack({len(names)}, " + ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names) + ") as (metric, value)"
    return metrics.selectExpr(f"`{model}`", st)


def rank_models(metrics: DataFrame, names: list[str], model: str = "model_name") -> DataFrame:
    """Rank of every model per metric (1 = best; lower-is-better metrics inverted)."""
    long = long_metrics(metrics, names, model)
    asc = F.col("metric").isin(*LOWER_IS_BETTER)
    key = F.when(asc, F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("metric").orderBy(key.asc_nulls_last(), F.col(model))
    return long.withColumn("rank", F.rank().over(w).cast("int"))


def metric_wins(metrics: DataFrame, names: list[str], model: str = "model_name") -> DataFrame:
    """Best model per metric and wins per model."""
    r = rank_models(metrics, names, model)
    first = r.withColumn("_rn", F.row_number().over(Window.partitionBy("metric").orderBy("rank", model))).where("_rn = 1")
    return first.groupBy(model).agg(F.count(F.lit(1)).alias("wins"),
                                    F.array_join(F.sort_array(F.collect_list("metric")), ",").alias("metrics"))


def metric_pivot(long: DataFrame, names: list[str], model: str = "model_name") -> DataFrame:
    """Model x metric table with a given metric list (no distinct pass)."""
    return long.groupBy(model).pivot("metric", names).agg(F.first("value"))


def metric_normalize(long: DataFrame, model: str = "model_name") -> DataFrame:
    """Min-max per metric, inverted where lower is better; equal values -> NULL-safe 0."""
    w = Window.partitionBy("metric")
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    norm = F.coalesce(F.try_divide(F.col("value") - lo, hi - lo), F.lit(0.0))
    return long.withColumn("normalized", F.when(F.col("metric").isin(*LOWER_IS_BETTER), 1 - norm).otherwise(norm))


def readiness(metrics: DataFrame, model: str = "model_name", gates: dict = GATES) -> DataFrame:
    """Four gates (inclusive), weighted confidence score, risk band."""
    checks = {f"{m}_check": F.col(m) >= g for m, g in gates.items()}
    score = sum(F.lit(GATE_WEIGHTS[m]) * F.least(F.col(m) / g, F.lit(1.0)) for m, g in gates.items())
    out = metrics.withColumns(checks).withColumn("confidence_score", score)
    ready = None
    for k in checks:
        ready = F.col(k) if ready is None else ready & F.col(k)
    return out.withColumn("ready_for_production", ready).withColumn(
        "risk_level", F.when(F.col("confidence_score") >= 0.95, "LOW").when(F.col("confidence_score") >= 0.85, "MEDIUM")
        .otherwise("HIGH"))


def recommendations(ready: DataFrame, model: str = "model_name", roi: str = "roi") -> DataFrame:
    """One message per failed gate, ROI < 50, or the all-clear."""
    msgs = F.array(*[F.when(~F.col(f"{m}_check"), F.lit(RECOMMENDATIONS[m])) for m in GATES],
                   F.when(F.coalesce(F.col(roi), F.lit(0.0)) < 50, F.lit(RECOMMENDATIONS["roi"])))
    kept = F.filter(msgs, lambda x: x.isNotNull())
    final = F.when(F.size(kept) == 0, F.array(F.lit(RECOMMENDATIONS["ok"]))).otherwise(kept)
    return ready.select(model, F.posexplode(final).alias("position", "recommendation"))


def metric_band(long: DataFrame) -> DataFrame:
    """Excellent / good / acceptable / poor per metric value."""
    e = None
    for m, (ex, gd, ac) in BANDS.items():
        band = (F.when(F.col("value") >= ex, "excellent").when(F.col("value") >= gd, "good")
                .when(F.col("value") >= ac, "acceptable").otherwise("poor"))
        e = F.when(F.col("metric") == m, band) if e is None else e.when(F.col("metric") == m, band)
    return long.withColumn("band", e)


def importance_cumulative(imp: DataFrame, feature: str = "feature", value: str = "importance") -> DataFrame:
    """Share and running share (importance rows: one per feature, a bounded frame)."""
    tot = F.sum(value).over(Window.partitionBy())
    w = Window.orderBy(F.desc(value), feature).rowsBetween(Window.unboundedPreceding, 0)
    out = imp.withColumn("share", F.col(value) / tot).withColumn("cumulative", F.sum(F.col(value)).over(w) / tot)
    out = out.withColumn("position", F.row_number().over(Window.orderBy(F.desc(value), feature)))
    need = lambda q: F.min(F.when(F.col("cumulative") >= q, F.col("position"))).over(Window.partitionBy())
    return out.withColumn("needed_80", need(0.8)).withColumn("needed_90", need(0.9))
