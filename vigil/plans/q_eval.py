"""Evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.operators import evaluation as V
from vigil.operators import prep as PR
from vigil.operators import profile as A
from vigil.operators import relational as RL
from vigil.operators import stats as ST
from vigil.plans.catalog import query, round_doubles
from vigil.plans.q_stats import _ENG_COLS, _ENG_CTE, eng_frame
from vigil.sources import fixtures as X

_H = PR.split_hash_sql()


def SC(body: str, extra: str = "") -> str:
    return X.with_sql(X.SCORED_SQL + extra, body)


def SM(body: str, extra: str = "") -> str:
    return X.with_sql(X.SCORED_MANY_SQL + extra, body)


_CELLS = """cells AS (SELECT count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, count(*) AS n FROM scored2)"""
_CNT = """cnt AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM scored2 GROUP BY p),
cum AS (SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tp,
  sum(neg) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS fp,
  (SELECT sum(pos) FROM cnt) AS n_pos, (SELECT sum(neg) FROM cnt) AS n_neg FROM cnt)"""


def _z(a, b):
    return f"coalesce(CAST({a} AS DOUBLE)/nullif({b}, 0), 0.0)"


# ---------------------------------------------------------------- V1-V2
@query("confusion_matrix", SC("""SELECT y, yhat, count FROM (SELECT y, yhat, count(*) AS count FROM scored2 GROUP BY ALL)
  RIGHT JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(gy, gyh) ON y = gy AND yhat = gyh""".replace(
    "SELECT y, yhat, count FROM", "SELECT gy AS y, gyh AS yhat, coalesce(count, 0) AS count FROM")))
def q_confusion_matrix(spark, sf):
    """V1: counts per (y, yhat), zero cells included."""
    return V.confusion_matrix(X.scored(spark, sf))


_P1, _R1 = _z("tp", "tp + fp"), _z("tp", "tp + fn")
_P0, _R0 = _z("tn", "tn + fn"), _z("tn", "tn + fp")


def _f1(p, r):
    return _z(f"2*{p}*{r}", f"{p} + {r}")


_METRICS_SQL = f"""round({_z('tp + tn', 'n')}, 6) AS accuracy,
  round({_z(f'{_P0}*(tn + fp) + {_P1}*(tp + fn)', 'n')}, 6) AS precision,
  round({_z(f'{_R0}*(tn + fp) + {_R1}*(tp + fn)', 'n')}, 6) AS recall,
  round({_z(f'{_f1(_P0, _R0)}*(tn + fp) + {_f1(_P1, _R1)}*(tp + fn)', 'n')}, 6) AS f1"""


@query("class_metrics", SC(f"""SELECT {_METRICS_SQL},
  round({_P0}, 6) AS precision_0, round({_R0}, 6) AS recall_0, round({_f1(_P0, _R0)}, 6) AS f1_0, tn + fp AS support_0,
  round({_P1}, 6) AS precision_1, round({_R1}, 6) AS recall_1, round({_f1(_P1, _R1)}, 6) AS f1_1, tp + fn AS support_1
  FROM cells""", ",\n" + _CELLS))
def q_class_metrics(spark, sf):
    """V2: accuracy, weighted and per-class precision / recall / F1 from the confusion cells."""
    return round_doubles(V.class_metrics(V.binary_cells(X.scored(spark, sf))))


# three classes: the machine type as truth, a rule on torque and wear as the prediction
_TYPES_SQL = """types AS (SELECT type AS y, CASE WHEN torque > 45 THEN 'L' WHEN wear > 120 THEN 'M' ELSE 'H' END AS yhat,
  torque AS p_l, wear AS p_m, -torque AS p_h FROM sensor)"""
_REPORT_SQL = _TYPES_SQL + """,
rep AS (SELECT c AS class, coalesce(CAST(tp AS DOUBLE)/nullif(said, 0), 0.0) AS pr, coalesce(CAST(tp AS DOUBLE)/nullif(support, 0), 0.0) AS rc, support, tp
  FROM (SELECT c, (SELECT count(*) FROM types WHERE y = c AND yhat = c) AS tp, (SELECT count(*) FROM types WHERE y = c) AS support,
        (SELECT count(*) FROM types WHERE yhat = c) AS said FROM (VALUES ('H'), ('L'), ('M')) v(c)))"""
_F1_SQL = "coalesce(2*pr*rc/nullif(pr + rc, 0), 0.0)"


def _types(spark, sf):
    s = X.sensor(spark, sf)
    said = F.when(F.col("torque") > 45, "L").when(F.col("wear") > 120, "M").otherwise("H")
    return s.select(F.col("type").alias("y"), said.alias("yhat"), F.col("torque").alias("p_l"), F.col("wear").alias("p_m"),
                    (-F.col("torque")).alias("p_h"))


@query("confusion_matrix_multi", X.with_sql(X.SENSOR_SQL + ",\n" + _TYPES_SQL, "SELECT y, yhat, count(*) AS count FROM types GROUP BY ALL"))
def q_confusion_matrix_multi(spark, sf):
    """V1 for any classes: counts per (y, yhat) of three machine types."""
    return V.confusion_long(_types(spark, sf))


@query("class_metrics_multi", X.with_sql(X.SENSOR_SQL + ",\n" + _REPORT_SQL, f"""SELECT class, round(pr, 6) AS precision, round(rc, 6) AS recall,
  round({_F1_SQL}, 6) AS f1, support, tp FROM rep"""))
def q_class_metrics_multi(spark, sf):
    """V2 for any classes: precision, recall, F1 and support per machine type."""
    return round_doubles(V.class_report(V.confusion_long(_types(spark, sf))))


@query("class_summary_multi", X.with_sql(X.SENSOR_SQL + ",\n" + _REPORT_SQL, f"""SELECT round(sum(tp)/sum(support), 6) AS accuracy,
  round(avg(pr), 6) AS macro_precision, round(sum(pr*support)/sum(support), 6) AS weighted_precision,
  round(avg(rc), 6) AS macro_recall, round(sum(rc*support)/sum(support), 6) AS weighted_recall,
  round(avg({_F1_SQL}), 6) AS macro_f1, round(sum({_F1_SQL}*support)/sum(support), 6) AS weighted_f1 FROM rep"""))
def q_class_summary_multi(spark, sf):
    """V2 for any classes: accuracy, macro and support-weighted averages."""
    return round_doubles(V.class_summary(V.class_report(V.confusion_long(_types(spark, sf)))))


def _ovr_sql(c, p):
    return f"""SELECT '{c}' AS class, round(sum(pos*(nb + neg/2.0))/(sum(pos)*sum(neg)), 6) AS auc FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM (
  SELECT {p} AS p, count(*) FILTER (WHERE y = '{c}') AS pos, count(*) FILTER (WHERE y <> '{c}') AS neg FROM types GROUP BY {p}))"""


@query("roc_auc_multi", X.with_sql(X.SENSOR_SQL + ",\n" + _TYPES_SQL, "\nUNION ALL\n".join(_ovr_sql(c, f"p_{c.lower()}") for c in "HLM")))
def q_roc_auc_multi(spark, sf):
    """V3 for any classes: one-vs-rest AUC of each machine type."""
    return round_doubles(V.roc_auc_ovr(_types(spark, sf), {c: f"p_{c.lower()}" for c in "HLM"}))


# ---------------------------------------------------------------- V3-V9
@query("roc_auc", SC("""SELECT round(sum(pos*(nb + neg/2.0))/(sum(pos)*sum(neg)), 6) AS auc FROM (
  SELECT p, pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM cnt)""",
                     ",\n" + _CNT))
def q_roc_auc(spark, sf):
    """V3: tie-aware AUC by rank sums over the distinct scores."""
    return round_doubles(V.roc_auc(X.scored(spark, sf)))


@query("roc_curve", SC("""SELECT p AS threshold, round(fp/n_neg, 6) AS fpr, round(tp/n_pos, 6) AS tpr FROM cum
  UNION ALL SELECT NULL, 0.0, 0.0""", ",\n" + _CNT))
def q_roc_curve(spark, sf):
    """V4: fpr / tpr of the rule p >= t for every distinct t, plus the origin."""
    return round_doubles(V.roc_curve(X.scored(spark, sf)))


@query("pr_curve", SC("""SELECT p AS threshold, round(tp/(tp + fp), 6) AS precision, round(tp/n_pos, 6) AS recall FROM cum
  UNION ALL SELECT NULL, 1.0, 0.0""", ",\n" + _CNT))
def q_pr_curve(spark, sf):
    """V5: precision / recall per distinct threshold plus the final (1, 0) point."""
    return round_doubles(V.pr_curve(X.scored(spark, sf)))


@query("average_precision", SC("""SELECT round(sum(pos/n_pos*(tp/(tp + fp))), 6) AS average_precision FROM cum""",
                               ",\n" + _CNT))
def q_average_precision(spark, sf):
    """V6: average precision = sum (R_n - R_n-1) P_n."""
    return round_doubles(V.average_precision(X.scored(spark, sf)))


@query("best_threshold", SC("""SELECT threshold, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy,
  round(precision, 6) AS precision, round(recall, 6) AS recall FROM (
  SELECT p AS threshold, 2*(tp/(tp + fp))*(tp/n_pos)/nullif(tp/(tp + fp) + tp/n_pos, 0) AS f1,
         (tp + n_neg - fp)/(n_pos + n_neg) AS accuracy, tp/(tp + fp) AS precision, tp/n_pos AS recall FROM cum)
  WHERE f1 IS NOT NULL ORDER BY f1 DESC, threshold DESC LIMIT 1""", ",\n" + _CNT))
def q_best_threshold(spark, sf):
    """V7: threshold of maximal F1 (p >= t) and the metrics there."""
    return round_doubles(V.best_threshold(X.scored(spark, sf)))


@query("calibration", SC("""SELECT CAST(least(floor(p*10), 9) AS INTEGER) AS bin, round(avg(p), 6) AS mean_predicted,
  round(avg(CAST(y AS DOUBLE)), 6) AS fraction_positive, count(*) AS count FROM scored2 GROUP BY ALL"""))
def q_calibration(spark, sf):
    """V8: 10 uniform probability bins: mean p and positive share."""
    return round_doubles(V.calibration(X.scored(spark, sf)))


@query("brier", SC("SELECT round(avg((p - y)*(p - y)), 6) AS brier FROM scored2"))
def q_brier(spark, sf):
    """V9: Brier score."""
    return round_doubles(V.brier(X.scored(spark, sf)))


# ---------------------------------------------------------------- V10-V12
def regression_frame(spark, sf):
    """Regression stand-in: tool wear against a fixed linear rule of torque."""
    s = X.sensor(spark, sf)
    return s.select("key", F.col("wear").alias("y"), (2.1 * F.col("torque") + 60).alias("yhat"))


_REG = ",\nreg AS (SELECT key, wear AS y, 2.1*torque + 60 AS yhat FROM sensor)"


@query("regression_metrics", X.with_sql(X.SENSOR_SQL + _REG, """SELECT round(avg((y - yhat)*(y - yhat)), 6) AS mse,
  round(sqrt(avg((y - yhat)*(y - yhat))), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae,
  round(1 - sum((y - yhat)*(y - yhat))/(sum(y*y) - sum(y)*sum(y)/count(*)), 6) AS r2,
  round(avg(abs((y - yhat)/nullif(y, 0)))*100, 6) AS mape, round(stddev_pop(y - yhat), 6) AS residual_std,
  round(quantile_cont(abs(y - yhat), 0.5), 6) AS median_ae, round(quantile_cont(abs(y - yhat), 0.75), 6) AS p75_ae,
  round(quantile_cont(abs(y - yhat), 0.9), 6) AS p90_ae, round(quantile_cont(abs(y - yhat), 0.95), 6) AS p95_ae,
  round(max(abs(y - yhat)), 6) AS max_error FROM reg"""))
def q_regression_metrics(spark, sf):
    """Regression metrics of the stand-in wear predictor."""
    return round_doubles(V.regression_metrics(regression_frame(spark, sf)))


@query("residuals", X.with_sql(X.SENSOR_SQL + _REG + """,
res AS (SELECT y - yhat AS r FROM reg), rg AS (SELECT min(r) AS lo, max(r) AS hi, avg(r) AS m, stddev_pop(r) AS sd FROM res)""",
    """SELECT CAST(least(floor((r - lo)/((hi - lo)/20)), 19) AS INTEGER) AS bin, count(*) AS count,
  round(lo + least(floor((r - lo)/((hi - lo)/20)), 19)*((hi - lo)/20), 6) AS bin_lo,
  round(lo + (least(floor((r - lo)/((hi - lo)/20)), 19) + 1)*((hi - lo)/20), 6) AS bin_hi,
  round(m, 6) AS residual_mean, round(sd, 6) AS residual_std FROM res, rg GROUP BY ALL"""))
def q_residuals(spark, sf):
    """Residual histogram (20 bins) with residual mean and std."""
    r = regression_frame(spark, sf).select((F.col("y") - F.col("yhat")).alias("r"))
    st = r.agg(F.avg("r"), F.stddev_pop("r")).first()
    h = A.histogram(r, "r", 20)
    return round_doubles(h.withColumns({"residual_mean": F.lit(st[0]), "residual_std": F.lit(st[1])}))


@query("score_distribution", SC("""SELECT y, bin, count(*) AS count, round(lo + bin*((hi - lo)/30), 6) AS bin_lo,
  round(lo + (bin + 1)*((hi - lo)/30), 6) AS bin_hi,
  round(count(*)/(sum(count(*)) OVER (PARTITION BY y)*((hi - lo)/30)), 6) AS density
  FROM (SELECT y, lo, hi, CAST(least(floor((p - lo)/((hi - lo)/30)), 29) AS INTEGER) AS bin
        FROM scored2, (SELECT min(p) AS lo, max(p) AS hi FROM scored2)) GROUP BY y, bin, lo, hi"""))
def q_score_distribution(spark, sf):
    """Probability histogram per true class with density."""
    return round_doubles(A.histogram(X.scored(spark, sf), "p", 30, by="y", density=True))


# ---------------------------------------------------------------- V13
@query("cost_failure_model", SC("""SELECT fp*500 + fn*8000 + (tp + fp)*1000 AS total_cost,
  tp*10000 - (fp*500 + fn*8000 + (tp + fp)*1000) AS total_value,
  round((tp*10000 - (fp*500 + fn*8000 + (tp + fp)*1000))*100.0/nullif(fp*500 + fn*8000 + (tp + fp)*1000, 0), 6) AS roi,
  (tp + fn)*10000 - (fp*500 + fn*8000 + (tp + fp)*1000) AS cost_savings FROM cells""", ",\n" + _CELLS))
def q_cost_failure_model(spark, sf):
    """Failure-cost business model."""
    return round_doubles(V.cost_failure_model(V.binary_cells(X.scored(spark, sf))))


@query("cost_downtime_model", SC("""SELECT fn*10000 AS cost_missed_failures, fp*1000 AS cost_unnecessary_maintenance,
  (tp + fp)*4*5000 AS production_loss, fn*10000 + fp*1000 + (tp + fp)*4*5000 AS total_cost,
  n*10000 - (fn*10000 + fp*1000 + (tp + fp)*4*5000) AS cost_savings,
  round(CASE WHEN n*10000 > 0 THEN (n*10000 - (fn*10000 + fp*1000 + (tp + fp)*4*5000))*100.0/(n*10000) ELSE 0.0 END, 6)
    AS cost_savings_percentage,
  round(CASE WHEN n*10000 > 0 THEN (n*10000 - (fn*10000 + fp*1000 + (tp + fp)*4*5000))*100.0/(n*10000) ELSE 0.0 END, 6)
    AS roi_percentage, n*10000 AS baseline_cost FROM cells""", ",\n" + _CELLS))
def q_cost_downtime_model(spark, sf):
    """Downtime business model (baseline = every row a failure, as defined)."""
    return round_doubles(V.cost_downtime_model(V.binary_cells(X.scored(spark, sf))))


@query("cost_matrix_model", SC("""SELECT tp*(-100) + tn*(-10) + fp*500 + fn*5000 AS total_cost, n*5000 AS reactive_cost,
  n*5000 - (tp*(-100) + tn*(-10) + fp*500 + fn*5000) AS savings,
  round(coalesce((n*5000 - (tp*(-100) + tn*(-10) + fp*500 + fn*5000))*100.0/nullif(abs(n*5000), 0), 0.0), 6) AS roi,
  round({d1}, 6) AS detection_rate, round({d2}, 6) AS false_alarm_rate,
  round(coalesce((tp*(-100) + tn*(-10) + fp*500 + fn*5000)*1.0/nullif(n, 0), 0.0), 6) AS cost_per_prediction
  FROM cells""".format(d1=_z("tp", "tp + fn"), d2=_z("fp", "fp + tn")), ",\n" + _CELLS))
def q_cost_matrix_model(spark, sf):
    """Cost-matrix business model."""
    return round_doubles(V.cost_matrix_model(V.binary_cells(X.scored(spark, sf))))


# ---------------------------------------------------------------- V25 + model tables
_NAMES = ["accuracy", "precision", "recall", "f1", "auc", "brier", "roi"]

_MANY_CTE = f""",
mcells AS (SELECT model_name, count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn, count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, count(*) AS n,
  avg((p - y)*(p - y)) AS brier FROM scored_many GROUP BY model_name),
mcnt AS (SELECT model_name, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
  FROM scored_many GROUP BY ALL),
mauc AS (SELECT model_name, sum(pos*(nb + neg/2.0))/(sum(pos)*sum(neg)) AS auc FROM (
  SELECT model_name, pos, neg, coalesce(sum(neg) OVER (PARTITION BY model_name ORDER BY p
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM mcnt) GROUP BY model_name),
metrics0 AS (SELECT model_name, {_METRICS_SQL.replace('round(', '(').replace(', 6) AS', ') AS')}, brier,
  tp*10000 - (fp*500 + fn*8000 + (tp + fp)*1000) AS business_value,
  (tp*10000 - (fp*500 + fn*8000 + (tp + fp)*1000))*100.0/nullif(fp*500 + fn*8000 + (tp + fp)*1000, 0) AS roi FROM mcells),
metrics AS (SELECT m.*, a.auc FROM metrics0 m JOIN mauc a USING (model_name)),
mlong AS (SELECT model_name, metric, value FROM metrics UNPIVOT (value FOR metric IN ({', '.join(_NAMES)})))"""


def metrics_many(spark, sf):
    return V.evaluate_many(X.scored_many(spark, sf))


@query("evaluate_many", SM("""SELECT model_name, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, round(auc, 6) AS auc, round(brier, 6) AS brier,
  business_value, round(roi, 6) AS roi FROM metrics""", _MANY_CTE))
def q_evaluate_many(spark, sf):
    """All scorers evaluated together: every metric is grouped by the model name (no loop over models)."""
    return round_doubles(metrics_many(spark, sf))


@query("rank_models", SM("""SELECT model_name, metric, round(value, 6) AS value,
  CAST(rank() OVER (PARTITION BY metric ORDER BY CASE WHEN metric IN ('rmse', 'mae', 'mape', 'mse', 'brier')
    THEN value ELSE -value END NULLS LAST, model_name) AS INTEGER) AS rank FROM mlong""", _MANY_CTE))
def q_rank_models(spark, sf):
    """Rank of every model per metric."""
    return round_doubles(V.rank_models(metrics_many(spark, sf), _NAMES))


@query("metric_wins", SM("""SELECT model_name, count(*) AS wins, array_to_string(list_sort(list(metric)), ',') AS metrics FROM (
  SELECT model_name, metric, row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric IN
    ('rmse', 'mae', 'mape', 'mse', 'brier') THEN value ELSE -value END NULLS LAST, model_name) AS rn FROM mlong)
  WHERE rn = 1 GROUP BY model_name""", _MANY_CTE))
def q_metric_wins(spark, sf):
    """Best model per metric (lower-is-better inverted) and wins per model."""
    return V.metric_wins(metrics_many(spark, sf), _NAMES)


@query("metric_pivot", SM("SELECT model_name, " + ", ".join(f"round({n}, 6) AS {n}" for n in _NAMES) + " FROM metrics",
                          _MANY_CTE))
def q_metric_pivot(spark, sf):
    """Model x metric from the long metric table (pivot with the given metric list)."""
    long = V.long_metrics(metrics_many(spark, sf), _NAMES)
    return round_doubles(V.metric_pivot(long, _NAMES))


@query("metric_normalize", SM("""SELECT model_name, metric, round(value, 6) AS value, round(CASE WHEN metric IN
  ('rmse', 'mae', 'mape', 'mse', 'brier') THEN 1 - nz ELSE nz END, 6) AS normalized FROM (
  SELECT *, coalesce((value - min(value) OVER (PARTITION BY metric))/nullif(max(value) OVER (PARTITION BY metric)
    - min(value) OVER (PARTITION BY metric), 0), 0.0) AS nz FROM mlong)""", _MANY_CTE))
def q_metric_normalize(spark, sf):
    """Min-max normalisation per metric (inverted where lower is better)."""
    return round_doubles(V.metric_normalize(V.long_metrics(metrics_many(spark, sf), _NAMES)))


_READY = """ready AS (SELECT *, accuracy >= 0.85 AS accuracy_check, precision >= 0.8 AS precision_check,
  recall >= 0.85 AS recall_check, f1 >= 0.82 AS f1_check,
  0.2*least(accuracy/0.85, 1.0) + 0.3*least(precision/0.8, 1.0) + 0.3*least(recall/0.85, 1.0) + 0.2*least(f1/0.82, 1.0)
    AS confidence_score FROM metrics)"""


@query("readiness", SM("""SELECT model_name, accuracy_check, precision_check, recall_check, f1_check,
  round(confidence_score, 6) AS confidence_score,
  accuracy_check AND precision_check AND recall_check AND f1_check AS ready_for_production,
  CASE WHEN confidence_score >= 0.95 THEN 'LOW' WHEN confidence_score >= 0.85 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level
  FROM ready""", _MANY_CTE + ",\n" + _READY))
def q_readiness(spark, sf):
    """Production gates, weighted confidence score and risk band per model."""
    r = V.readiness(metrics_many(spark, sf))
    return round_doubles(r.select("model_name", "accuracy_check", "precision_check", "recall_check", "f1_check",
                                  "confidence_score", "ready_for_production", "risk_level"))


def _rec_sql():
    arms = [f"SELECT model_name, {i} AS o, '{V.RECOMMENDATIONS[m]}' AS recommendation FROM ready WHERE NOT {m}_check"
            for i, m in enumerate(V.GATES)]
    arms.append(f"SELECT model_name, 4, '{V.RECOMMENDATIONS['roi']}' FROM ready WHERE coalesce(roi, 0.0) < 50")
    return f"""SELECT model_name, CAST(row_number() OVER (PARTITION BY model_name ORDER BY o) - 1 AS INTEGER) AS position,
  recommendation FROM ({' UNION ALL '.join(arms)}
  UNION ALL SELECT model_name, 5, '{V.RECOMMENDATIONS['ok']}' FROM ready
    WHERE accuracy_check AND precision_check AND recall_check AND f1_check AND coalesce(roi, 0.0) >= 50)"""


@query("recommendations", SM(_rec_sql(), _MANY_CTE + ",\n" + _READY))
def q_recommendations(spark, sf):
    """One message per failed gate or low ROI, else the all-clear."""
    return V.recommendations(V.readiness(metrics_many(spark, sf)))


@query("importance_cumulative", X.with_sql(X.SENSOR_SQL + _ENG_CTE, """SELECT feature, round(importance, 6) AS importance,
  round(importance/sum(importance) OVER (), 6) AS share,
  round(sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING)/sum(importance) OVER (), 6)
    AS cumulative, CAST(position AS INTEGER) AS position,
  CAST(min(CASE WHEN c >= 0.8 THEN position END) OVER () AS INTEGER) AS needed_80,
  CAST(min(CASE WHEN c >= 0.9 THEN position END) OVER () AS INTEGER) AS needed_90 FROM (
  SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS position,
    sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING)/sum(importance) OVER () AS c FROM (
    """ + " UNION ALL ".join(f"SELECT '{x}' AS feature, abs(corr({x}, failure)) AS importance FROM eng" for x in _ENG_COLS)
    + "))"))
def q_importance_cumulative(spark, sf):
    """Cumulative importance share (importance = |corr| with the target) and features needed for 80 / 90 %."""
    imp = ST.corr_target(eng_frame(spark, sf), _ENG_COLS, "failure").select("feature", F.col("abs_r").alias("importance"))
    out = V.importance_cumulative(imp)
    return round_doubles(out.select("feature", "importance", "share", "cumulative", F.col("position").cast("int"),
                                    F.col("needed_80").cast("int"), F.col("needed_90").cast("int")))


@query("metric_band", SM("""SELECT model_name, metric, round(value, 6) AS value, CASE
  """ + " ".join(f"WHEN metric = '{m}' THEN CASE WHEN value >= {a} THEN 'excellent' WHEN value >= {b} THEN 'good' "
                 f"WHEN value >= {c} THEN 'acceptable' ELSE 'poor' END" for m, (a, b, c) in V.BANDS.items())
    + " END AS band FROM mlong", _MANY_CTE))
def q_metric_band(spark, sf):
    """Performance band of every metric value."""
    return round_doubles(V.metric_band(V.long_metrics(metrics_many(spark, sf), _NAMES)))


@query("evaluation_summary", SM("""SELECT count(*) AS models, round(avg(accuracy), 6) AS average_accuracy,
  round(avg(f1), 6) AS average_f1, CAST(sum(business_value) AS BIGINT) AS total_business_value,
  count(*) FILTER (WHERE accuracy >= 0.85 AND precision >= 0.8 AND recall >= 0.85 AND f1 >= 0.82) AS models_meeting_gates,
  arg_max(model_name, f1) AS best_model FROM metrics""", _MANY_CTE))
def q_evaluation_summary(spark, sf):
    """Averages and totals over the evaluated models."""
    m = metrics_many(spark, sf)
    gate = (F.col("accuracy") >= 0.85) & (F.col("precision") >= 0.8) & (F.col("recall") >= 0.85) & (F.col("f1") >= 0.82)
    out = m.agg(F.count(F.lit(1)).alias("models"), F.avg("accuracy").alias("average_accuracy"),
                F.avg("f1").alias("average_f1"), F.sum("business_value").cast("long").alias("total_business_value"),
                F.count_if(gate).alias("models_meeting_gates"), F.max_by("model_name", "f1").alias("best_model"))
    return round_doubles(out)


@query("comparison_table", SM("""SELECT CAST(row_number() OVER (ORDER BY f1 DESC, model_name) AS INTEGER) AS position,
  model_name, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, round(auc, 6) AS auc FROM metrics""", _MANY_CTE))
def q_comparison_table(spark, sf):
    """One row per model, ordered by F1 (position column)."""
    m = metrics_many(spark, sf)
    out = m.select(F.row_number().over(Window.orderBy(F.desc("f1"), "model_name")).cast("int").alias("position"),
                   "model_name", "accuracy", "precision", "recall", "f1", "auc")
    return round_doubles(out)


@query("best_model", SM("""SELECT arg_max(model_name, f1) AS best_by_f1, arg_max(model_name, auc) AS best_by_auc,
  arg_min(model_name, brier) AS best_by_brier FROM metrics""", _MANY_CTE))
def q_best_model(spark, sf):
    """Arg max / arg min of a metric."""
    m = metrics_many(spark, sf)
    return m.agg(F.max_by("model_name", "f1").alias("best_by_f1"), F.max_by("model_name", "auc").alias("best_by_auc"),
                 F.min_by("model_name", "brier").alias("best_by_brier"))


@query("filter_threshold_gate", SM("""SELECT model_name, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM metrics
  WHERE accuracy >= 0.85 AND precision >= 0.8 AND recall >= 0.85 AND f1 >= 0.82""", _MANY_CTE))
def q_filter_threshold_gate(spark, sf):
    """P10: models meeting every readiness gate."""
    m = RL.filter_gate(metrics_many(spark, sf))
    return round_doubles(m.select("model_name", "accuracy", "f1"))


_SPLIT_CTE = f""",
rk AS (SELECT key, row_number() OVER (PARTITION BY failure ORDER BY {_H}, key) - 1 AS r, count(*) OVER (PARTITION BY failure) AS nc
       FROM sensor),
sp AS (SELECT key, CASE WHEN r < floor(nc*0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM rk)"""


@query("join_train_eval", SM("""SELECT coalesce(t.model_name, e.model_name) AS model_name, round(train_accuracy, 6) AS train_accuracy,
  round(test_accuracy, 6) AS test_accuracy FROM
  (SELECT model_name, avg(CAST(y = yhat AS DOUBLE)) AS train_accuracy FROM scored_many JOIN sp USING (key)
   WHERE split = 'train' GROUP BY ALL) t FULL JOIN
  (SELECT model_name, avg(CAST(y = yhat AS DOUBLE)) AS test_accuracy FROM scored_many JOIN sp USING (key)
   WHERE split = 'test' GROUP BY ALL) e ON t.model_name = e.model_name""", _SPLIT_CTE))
def q_join_train_eval(spark, sf):
    """Per-model training record joined with the evaluation record."""
    sm = X.scored_many(spark, sf)
    split = PR.split_stratified(X.sensor(spark, sf).select("key", "failure"), "failure", "key", 0.2, 0.0).select("key", "split")
    j = sm.join(split, "key")
    acc = F.avg((F.col("y") == F.col("yhat")).cast("double"))
    tr = j.where(F.col("split") == "train").groupBy("model_name").agg(acc.alias("train_accuracy"))
    te = j.where(F.col("split") == "test").groupBy("model_name").agg(acc.alias("test_accuracy"))
    return round_doubles(RL.join_train_eval(tr, te))


@query("model_rollup", SM("""SELECT arg_max(model_name, f1) AS best_model, count(*) AS total_models,
  count(*) FILTER (WHERE accuracy >= 0.85 AND precision >= 0.8 AND recall >= 0.85 AND f1 >= 0.82) AS production_ready_models,
  round(avg(f1), 6) AS average_f1_score, round(avg(roi), 6) AS average_roi FROM metrics""", _MANY_CTE))
def q_model_rollup(spark, sf):
    """Best model, ready count and averages over the evaluated models."""
    m = metrics_many(spark, sf)
    gate = (F.col("accuracy") >= 0.85) & (F.col("precision") >= 0.8) & (F.col("recall") >= 0.85) & (F.col("f1") >= 0.82)
    return round_doubles(m.agg(F.max_by("model_name", "f1").alias("best_model"), F.count(F.lit(1)).alias("total_models"),
                               F.count_if(gate).alias("production_ready_models"), F.avg("f1").alias("average_f1_score"),
                               F.avg("roi").alias("average_roi")))
