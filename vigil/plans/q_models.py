"""Model fitting, search, selection loops and model-based queries (rows-only checks).

Single fits use ``pyspark.ml`` on the assembled sensor frame; searches, curves and
selection loops over trees use ``operators.forest``, which grows them together.
"""

from __future__ import annotations

import statistics

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import features as FX
from vigil.operators import boosting as BO
from vigil.operators import evaluation as V
from vigil.operators import forest as FO
from vigil.operators import kernel as KN
from vigil.operators import linear as LN
from vigil.operators import ml as ML
from vigil.operators import prep as PR
from vigil.operators import profile as PF
from vigil.operators import relational as RL
from vigil.operators import scoring as R
from vigil.operators import sequence as SQ
from vigil.operators import stats as ST
from vigil.plans import models as M
from vigil.plans.catalog import query, round_doubles
from vigil.session import work_dir
from vigil.sources import fixtures as X

BASE = ["air_temp", "proc_temp", "speed", "torque", "wear", "type_L", "type_M"]
ENG = BASE + ["temp_difference", "mechanical_power", "wear_torque_interaction", "stress_index", "speed_torque_ratio"]
FOLDS = 5
FOREST = 100  # trees of every forest


def model_frame(spark, sf: str, extended: bool = False, folds: int = FOLDS) -> DataFrame:
    """Sensor rows with one-hot type (drop-first), optional engineered columns,
    ``label`` and the deterministic ``split`` / ``fold`` columns; cached."""
    s = X.sensor(spark, sf)
    s = PR.onehot(s, "type", PR.fit_levels(s, "type"), drop_first=True)
    if extended:
        params = FX.fit_extended(s)
        cols = {**FX.temperature_cols(), **FX.power_cols(), **FX.wear_cols(),
                **FX.operational_cols(params["operational"]), **FX.interaction_cols()}
        s = s.withColumns({k: cols[k] for k in ENG if k not in BASE})
    s = s.withColumn("label", F.col("failure").cast("double"))
    s = PR.split_and_fold(s, "failure", "key", 0.2, folds)
    keep = ["key", "machine_id", "ts", "label", "split", "fold"] + (ENG if extended else BASE)
    return ML.persist(s.select(*keep))


def train_bins(d: DataFrame, cols: list[str], ordered: bool = False) -> FO.Binned:
    """The training rows of a model frame, binned for the forests; ``ordered`` for shares of the rows."""
    return FO.bin_table(d.where("split = 'train'"), cols, "key", "label", ordered=ordered)


def _py(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    return float(v)


def _metrics_df(spark, rows: list[dict], cols: list[str]):
    return round_doubles(spark.createDataFrame([tuple(_py(r.get(c)) for c in cols) for r in rows],
                                               ", ".join(f"{c} {'string' if c in ('model_name', 'split', 'status', 'error', 'feature_set', 'preset', 'param', 'verdict', 'method', 'features') else 'double'}" for c in cols)))


_MC = ["model_name", "accuracy", "precision", "recall", "f1", "auc"]


def _fit_one(spark, sf, name, family, **kw):
    d = model_frame(spark, sf)
    n = d.where("split = 'train'").count()
    if family in ("logistic", "svm"):
        kw.setdefault("n_rows", n)
    pipe = M.pipeline(family, BASE, **kw)
    _, m = ML.fit_evaluate(pipe, d.where("split = 'train'"), d.where("split = 'test'"))
    m["model_name"] = name
    out = _metrics_df(spark, [m], _MC)
    d.unpersist()
    return out


@query("model_logistic")
def q_model_logistic(spark, sf):
    """G1: logistic regression (C=1, L2 -> regParam 1/(C n)) on standardised input; test metrics."""
    return _fit_one(spark, sf, "logistic_regression", "logistic", max_iter=100)


@query("model_random_forest")
def q_model_random_forest(spark, sf):
    """Random forest (100 trees, depth 8); test metrics."""
    return _fit_one(spark, sf, "random_forest", "random_forest", n_estimators=FOREST, max_depth=8)


@query("model_decision_tree")
def q_model_decision_tree(spark, sf):
    """Decision tree (depth 10, gini); test metrics."""
    return _fit_one(spark, sf, "decision_tree", "decision_tree", max_depth=10)


@query("model_gbt")
def q_model_gbt(spark, sf):
    """Newton boosting (100 rounds, depth 4, L2 1); test metrics."""
    d = model_frame(spark, sf)
    model = BO.fit(spark, train_bins(d, BASE), BO.Boost(depth=4))
    p = BO.predict(model, d.where("split = 'test'"), "key", ["label"])
    m = ML.metrics_row(p.select("key", F.col("label").cast("int").alias("y"), (F.col("score") > 0.5).cast("int").alias("yhat"),
                                F.col("score").alias("p")))
    m["model_name"] = "gradient_boosting"
    out = _metrics_df(spark, [m], _MC)
    d.unpersist()
    return out


@query("model_mlp")
def q_model_mlp(spark, sf):
    """Multilayer perceptron [p, 16, 8, 2] on standardised input; test metrics."""
    return _fit_one(spark, sf, "mlp", "mlp", max_iter=50)


@query("model_svm")
def q_model_svm(spark, sf):
    """RBF SVM (squared hinge, 64 Nyström landmarks, gamma='scale'); probability by a
    logistic fit on the margin (Platt); test metrics."""
    from pyspark.ml.classification import LogisticRegression

    d = model_frame(spark, sf)
    tr, te = d.where("split = 'train'"), d.where("split = 'test'")
    model = KN.fit(tr, BASE, "label")
    margin = lambda df: VectorAssembler(inputCols=["margin"], outputCol="m").transform(KN.predict(df, model))
    platt = LogisticRegression(featuresCol="m", labelCol="label", predictionCol="platt_pred",
                               rawPredictionCol="platt_raw").fit(margin(tr))
    pred = platt.transform(margin(te))
    scored = pred.select("key", F.col("label").cast("int").alias("y"), (F.col("margin") > 0).cast("int").alias("yhat"),
                         vector_to_array("probability")[1].alias("p"))
    m = ML.metrics_row(scored)
    m["model_name"] = "svm_rbf"
    out = _metrics_df(spark, [m], _MC)
    d.unpersist()
    return out


def _regress(spark, sf, name, family, **kw):
    d = model_frame(spark, sf)
    feats = [c for c in BASE if c != "wear"]
    pipe = M.pipeline(family, feats, label="wear", **kw)
    model = pipe.fit(d.where("split = 'train'"))
    pred = model.transform(d.where("split = 'test'")).select(F.col("wear").alias("y"), F.col("prediction").alias("yhat"))
    out = V.regression_metrics(pred).withColumn("model_name", F.lit(name))
    return round_doubles(out)


@query("model_rf_regressor")
def q_model_rf_regressor(spark, sf):
    """Random-forest regression (100 trees) of tool wear on the other sensors; regression metrics."""
    return _regress(spark, sf, "rf_regressor", "rf_regressor", n_estimators=FOREST, max_depth=8)


@query("model_gbt_regressor")
def q_model_gbt_regressor(spark, sf):
    """Newton boosting of tool wear (100 rounds at most, stopping when the held-out fold 0 gets no better for 10); regression metrics."""
    d = model_frame(spark, sf)
    feats = [c for c in BASE if c != "wear"]
    bins = FO.bin_table(d.where("split = 'train'"), feats, "key", "wear", real=True, ordered=False)
    model = BO.fit(spark, bins, BO.Boost(depth=4, patience=10), valid_fold=0)
    pred = BO.predict(model, d.where("split = 'test'"), "key", ["wear"]).select(F.col("wear").alias("y"), F.col("score").alias("yhat"))
    return round_doubles(V.regression_metrics(pred).withColumn("model_name", F.lit("gbt_regressor")))


@query("model_svr")
def q_model_svr(spark, sf):
    """RBF SVR (squared epsilon-insensitive loss, 64 Nyström landmarks) of tool wear; regression metrics."""
    d = model_frame(spark, sf)
    model = KN.fit(d.where("split = 'train'"), [c for c in BASE if c != "wear"], "wear", epsilon=0.1)
    pred = KN.predict(d.where("split = 'test'"), model, "yhat").select(F.col("wear").alias("y"), "yhat")
    return round_doubles(V.regression_metrics(pred).withColumn("model_name", F.lit("svr")))


# ---------------------------------------------------------------- nearest neighbours
def _emb(spark, sf):
    return X.table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


_KNN_CTE = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id AS qid, b.vec_id AS nid, b.label AS nlabel,
        round(sqrt(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))), 9) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
nb AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY qid ORDER BY dist, nid) <= 5)"""


@query("knn_classify", f"""WITH {_KNN_CTE},
votes AS (SELECT qid, nlabel, count(*) AS n FROM nb GROUP BY ALL)
SELECT v.qid, CAST(arg_max(nlabel, (n, -nlabel)) AS INTEGER) AS prediction, any_value(e.label) AS label
FROM votes v JOIN e ON e.vec_id = v.qid GROUP BY v.qid""")
def q_knn_classify(spark, sf):
    """Leave-one-out 5-NN label vote over the embeddings (exact Euclidean, ties by id)."""
    e = _emb(spark, sf)
    pred = ML.knn(e, e, "vec_id", "vec_id", "embedding", "label", k=5, exclude_self=True)
    return pred.join(e.select(F.col("vec_id").alias("qid"), "label"), "qid")


@query("knn_regress", f"""WITH {_KNN_CTE}
SELECT qid, round(sum(CASE WHEN dist = 0 THEN 1e12 ELSE 1/dist END*nlabel)/sum(CASE WHEN dist = 0 THEN 1e12 ELSE 1/dist END), 6)
  AS prediction FROM nb GROUP BY qid""")
def q_knn_regress(spark, sf):
    """Leave-one-out 5-NN mean of the neighbours' values (label as a number), distance-weighted."""
    e = _emb(spark, sf)
    return round_doubles(ML.knn(e, e, "vec_id", "vec_id", "embedding", "label", k=5, exclude_self=True,
                                task="regress", weights="distance"))


# ---------------------------------------------------------------- reconstruction
@query("anomaly_reconstruction")
def q_anomaly_reconstruction(spark, sf):
    """PCA(2) reconstruction error on standardised sensors, threshold at the 95th percentile."""
    s = X.sensor(spark, sf)
    model, thr = ML.fit_reconstruction(s, ["air_temp", "proc_temp", "speed", "torque", "wear"], k=2, contamination=0.05)
    out = ML.anomaly_scores(model, thr, s).select("key", "recon_error", "anomaly", "anomaly_score")
    return round_doubles(out)


@query("encode_latent")
def q_encode_latent(spark, sf):
    """Two latent coordinates per reading (PCA on standardised sensors)."""
    s = X.sensor(spark, sf)
    model, _ = ML.fit_reconstruction(s, ["air_temp", "proc_temp", "speed", "torque", "wear"], k=2)
    t = model.transform(s)
    z = vector_to_array("latent")
    return round_doubles(t.select("key", z[0].alias("z0"), z[1].alias("z1")))


@query("model_sequence")
def q_model_sequence(spark, sf):
    """Windows of the 10 previous readings per machine (W1), flattened plus mean / std /
    slope, into gradient-boosted trees predicting whether the next reading alerts (value >= 100)."""
    rd = X.readings(spark, sf)
    seq = SQ.sequences(rd, "machine_id", ["ts", "key"], "value", 10, label=(F.col("value") >= 100).cast("double"))
    seq = seq.withColumns({**SQ.flatten(F.col("seq"), 10), **SQ.sequence_summary(F.col("seq"), 10)})
    feats = [f"lag_{i}" for i in range(1, 11)] + ["seq_mean", "seq_std", "seq_slope"]
    seq = PR.split_and_fold(seq, "label", "key", 0.2, FOLDS)
    seq = ML.persist(seq)
    pipe = M.pipeline("gbt", feats, n_estimators=15, max_depth=4)
    _, m = ML.fit_evaluate(pipe, seq.where("split = 'train'"), seq.where("split = 'test'"))
    m["model_name"] = "sequence_gbt"
    out = _metrics_df(spark, [m], _MC)
    seq.unpersist()
    return out


# ---------------------------------------------------------------- training / search
@query("train_model")
def q_train_model(spark, sf):
    """Small grid search -> refit -> CV on train -> metrics on train and test -> importances."""
    d = model_frame(spark, sf)
    tr = d.where("split = 'train'")
    pipe = M.pipeline("random_forest", BASE, n_estimators=FOREST, max_depth=6)
    rf = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [4, 8]).build()
    cvm = ML.grid_search(pipe, grid, tr)
    best = cvm.bestModel
    rows = []
    for split, part in (("train", tr), ("test", d.where("split = 'test'"))):
        m = ML.metrics_row(ML.scored_from(best.transform(part)))
        m.update(split=split, model_name="random_forest")
        rows.append(m)
    cv = ML.cross_validate(lambda n: M.pipeline("random_forest", BASE, n_estimators=FOREST,
                                              max_depth=best.stages[-1].getOrDefault("maxDepth")), tr, FOLDS)
    for r in rows:
        r.update(cv_mean=cv["mean"], cv_std=cv["std"])
    out = _metrics_df(spark, rows, ["model_name", "split", "accuracy", "precision", "recall", "f1", "auc", "cv_mean", "cv_std"])
    d.unpersist()
    return out


@query("train_many")
def q_train_many(spark, sf):
    """A suite trained on one cached frame; a model that fails (multinomial NB on
    negative standardised input) is recorded and skipped, the others continue."""
    d = model_frame(spark, sf)
    tr, te = d.where("split = 'train'"), d.where("split = 'test'")
    n = tr.count()
    rows = []
    suite = dict(M.BASELINE_SUITE)
    for name, (family, kw) in suite.items():
        try:
            _, m = ML.fit_evaluate(M.pipeline(family, BASE, **dict(kw, **({"n_rows": n} if family == "logistic" else {}))), tr, te)
            m.update(model_name=name, status="ok", error=None)
        except Exception as e:  # noqa: BLE001
            m = {"model_name": name, "status": "failed", "error": type(e).__name__}
        rows.append(m)
    try:
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import StandardScaler
        nb = Pipeline(stages=[VectorAssembler(inputCols=BASE, outputCol="raw"),
                              StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                              NaiveBayes(modelType="multinomial", labelCol="label")])
        _, m = ML.fit_evaluate(nb, tr, te)
        m.update(model_name="multinomial_nb", status="ok", error=None)
    except Exception as e:  # noqa: BLE001
        m = {"model_name": "multinomial_nb", "status": "failed", "error": type(e).__name__}
    rows.append(m)
    out = _metrics_df(spark, rows, ["model_name", "status", "error", "accuracy", "f1", "auc"])
    d.unpersist()
    return out


def _search(spark, sf, points: list[FO.Candidate]):
    """Weighted F1 of every candidate over three folds, the best first."""
    d = model_frame(spark, sf, folds=3)
    scores = FO.search(spark, train_bins(d, BASE), BASE, points, 3)
    name = lambda c: f"numTrees={c.trees}, maxDepth={c.depth}, minSplit={c.min_split}, minLeaf={c.min_leaf}, tried={c.mtry or 'sqrt'}"
    rows = [{"param": name(c), "f1": sum(v) / 3, "f1_std": statistics.pstdev(v)} for c, v in zip(points, scores)]
    rows.sort(key=lambda r: (-r["f1"], r["param"]))
    d.unpersist()
    return _metrics_df(spark, rows, ["param", "f1", "f1_std"])


@query("grid_search")
def q_grid_search(spark, sf):
    """T4: all 24 combinations of numTrees x maxDepth x minLeaf scored by weighted F1 over three folds."""
    return _search(spark, sf, [FO.Candidate(t, d, min_leaf=m) for t in (50, 100) for d in (3, 5, 8, 10) for m in (1, 2, 4)])


@query("random_search")
def q_random_search(spark, sf):
    """T5: 50 seeded draws from a space of 360 points, scored as in T4."""
    space = [FO.Candidate(t, d, s, m, f) for t in (25, 50, 75, 100) for d in (3, 4, 5, 6, 8) for s in (2, 5, 10) for m in (1, 2, 4)
             for f in (None, 4)]
    return _search(spark, sf, ML.sample_grid(space, 50, seed=42))


@query("cross_validate")
def q_cross_validate(spark, sf):
    """5-fold accuracy of logistic regression: scores, mean, population std, min, max."""
    d = model_frame(spark, sf)
    cv = ML.cross_validate(lambda n: M.pipeline("logistic", BASE, n_rows=n), d.where("split = 'train'"), FOLDS)
    rows = [{"model_name": "logistic_regression", "fold": float(i), "accuracy": s} for i, s in enumerate(cv["scores"])]
    out = spark.createDataFrame([(r["model_name"], int(r["fold"]), r["accuracy"], cv["mean"], cv["std"], cv["min"], cv["max"])
                                 for r in rows], "model_name string, fold int, accuracy double, mean double, std double, "
                                                 "min double, max double")
    d.unpersist()
    return round_doubles(out)


def _train_and_held(cells: list[dict]) -> dict:
    """Mean and population std of the train and held-out accuracies over the folds."""
    t, v = ([FO.metrics(c[part])["accuracy"] for c in cells] for part in ("train", "held"))
    return {"train_mean": statistics.fmean(t), "train_std": statistics.pstdev(t), "val_mean": statistics.fmean(v), "val_std": statistics.pstdev(v)}


@query("learning_curve")
def q_learning_curve(spark, sf):
    """A tree of depth 6 on ten nested shares of the training rows (10 to 100 % of every
    fold, exact) x 5 folds: train and validation accuracy, gap and over-fitting verdict (> .1
    high, > .05 moderate).  The 50 trees grow together."""
    d = model_frame(spark, sf)
    forests = [FO.Forest(tuple(BASE), skip_fold=f, share=tenth / 10, trees=1, depth=6, mtry=len(BASE), bootstrap=False)
               for tenth in range(1, 11) for f in range(FOLDS)]
    cells = FO.evaluate(spark, FO.grow(spark, train_bins(d, BASE, ordered=True), forests))
    rows = []
    for i in range(10):
        mine = [{p: cells[i * FOLDS + f, p] for p in ("train", "held")} for f in range(FOLDS)]
        r = _train_and_held(mine)
        gap = r["train_mean"] - r["val_mean"]
        rows.append({**r, "size": (i + 1) / 10, "n_rows": float(sum(m["train"].sum() for m in mine)) / FOLDS, "gap": gap,
                     "verdict": "high" if gap > 0.1 else "moderate" if gap > 0.05 else "good"})
    out = _metrics_df(spark, rows, ["size", "n_rows", "train_mean", "train_std", "val_mean", "val_std", "gap", "verdict"])
    d.unpersist()
    return out


@query("validation_curve")
def q_validation_curve(spark, sf):
    """Tree depth 2, 4, 6, 8, 10 x 5 folds: mean train and validation accuracy of views of one growth."""
    d = model_frame(spark, sf)
    depths = (2, 4, 6, 8, 10)
    grown = FO.grow(spark, train_bins(d, BASE), [FO.Forest(tuple(BASE), skip_fold=f, trees=1, depth=10, mtry=len(BASE), bootstrap=False)
                                                 for f in range(FOLDS)])
    cells = FO.evaluate(spark, grown, [FO.View(f, 1, k) for k in depths for f in range(FOLDS)])
    rows = [{"param": f"maxDepth={k}", **_train_and_held([{p: cells[i * FOLDS + f, p] for p in ("train", "held")} for f in range(FOLDS)])}
            for i, k in enumerate(depths)]
    out = _metrics_df(spark, rows, ["param", "train_mean", "val_mean", "val_std"])
    d.unpersist()
    return out


@query("run_experiment")
def q_run_experiment(spark, sf):
    """T9: 'baseline' preset (baseline features, no search) and 'full' preset (engineered
    features, importance selection, small search); test metrics of each."""
    rows = []
    d = model_frame(spark, sf)
    _, m = ML.fit_evaluate(M.pipeline("random_forest", BASE, n_estimators=FOREST, max_depth=6),
                           d.where("split = 'train'"), d.where("split = 'test'"))
    m.update(preset="baseline", features=",".join(BASE))
    rows.append(m)
    d.unpersist()
    e = model_frame(spark, sf, extended=True)
    tr = e.where("split = 'train'")
    imp = ML.importances(M.pipeline("random_forest", ENG, n_estimators=FOREST, max_depth=6).fit(tr), ENG)
    chosen = [f for f, _ in imp[:6]]
    pipe = M.pipeline("random_forest", chosen, n_estimators=FOREST)
    cvm = ML.grid_search(pipe, ParamGridBuilder().addGrid(pipe.getStages()[-1].maxDepth, [4, 8]).build(), tr)
    m = ML.metrics_row(ML.scored_from(cvm.bestModel.transform(e.where("split = 'test'"))))
    m.update(preset="full", features=",".join(chosen))
    rows.append(m)
    e.unpersist()
    return _metrics_df(spark, rows, ["preset", "features", "accuracy", "precision", "recall", "f1", "auc"])


@query("model_suite")
def q_model_suite(spark, sf):
    """The baseline and the optimised suite from the registry, fitted on one cached frame; test metrics."""
    d = model_frame(spark, sf)
    n = d.where("split = 'train'").count()
    rows = []
    for name, (family, kw) in {**M.BASELINE_SUITE, **M.OPTIMIZED_SUITE}.items():
        kw = dict(kw, **({"n_rows": n} if family == "logistic" else {}))
        _, m = ML.fit_evaluate(M.pipeline(family, BASE, **kw), d.where("split = 'train'"), d.where("split = 'test'"))
        m["model_name"] = name
        rows.append(m)
    out = _metrics_df(spark, rows, _MC)
    d.unpersist()
    return out


@query("prepare_training")
def q_prepare_training(spark, sf):
    """Preprocess -> validate -> feature set -> split; samples, features and split counts in one aggregate."""
    s = X.sensor(spark, sf)
    violations = RL.validate_inputs(s, ["air_temp", "proc_temp", "speed", "torque", "wear"], "failure").count()
    fs = FX.feature_set(s, "wear_focus", keep=["key", "failure"])
    sp = PR.split_stratified(fs, "failure", "key", 0.2, 0.1)
    n_feat = len(fs.columns) - 2
    return sp.agg(F.count(F.lit(1)).alias("samples"), F.lit(n_feat).alias("features"),
                  F.lit(violations).cast("long").alias("violations"),
                  F.count_if(F.col("split") == "train").alias("train_rows"),
                  F.count_if(F.col("split") == "val").alias("val_rows"),
                  F.count_if(F.col("split") == "test").alias("test_rows"))


_H = PR.split_hash_sql()
_NUM4 = ["air_temp", "proc_temp", "speed", "torque"]
_T1_SQL = X.with_sql(X.SENSOR_NULLS_SQL + """,
imp AS (SELECT key,
  coalesce(type, (SELECT type FROM sensor_nulls WHERE type IS NOT NULL GROUP BY type ORDER BY count(*) DESC, type LIMIT 1)) AS type,
  air_temp, proc_temp, speed, coalesce(torque, (SELECT quantile_cont(torque, 0.5) FROM sensor_nulls)) AS torque, failure
  FROM sensor_nulls),
sc AS (SELECT key, failure, CAST(type = 'L' AS INTEGER) AS type_L, CAST(type = 'M' AS INTEGER) AS type_M, """ + ", ".join(
    f"({c} - (SELECT avg({c}) FROM imp))/coalesce(nullif((SELECT stddev_pop({c}) FROM imp), 0), 1.0) AS {c}" for c in _NUM4) + """
  FROM imp),
rk AS (SELECT *, row_number() OVER (PARTITION BY failure ORDER BY """ + _H + """, key) - 1 AS r,
  count(*) OVER (PARTITION BY failure) AS n FROM sc)""", """SELECT key, failure, type_L, type_M, """ + ", ".join(
    f"round({c}, 6) AS {c}" for c in _NUM4) + """,
  CASE WHEN r < floor(n*0.2 + 0.5) THEN 'test'
       WHEN r < floor(n*0.2 + 0.5) + floor((n - floor(n*0.2 + 0.5))*""" + repr(0.1 / (1 - 0.2)) + """ + 0.5) THEN 'val'
       ELSE 'train' END AS split FROM rk""")


@query("preprocess_flow", _T1_SQL)
def q_preprocess_flow(spark, sf):
    """Load -> quality report -> impute (auto) -> outlier report -> encode -> standard
    scale (not the target) -> stratified split; both reports and the splits are written,
    the splits read back."""
    s = X.sensor_nulls(spark, sf).select("key", "type", "air_temp", "proc_temp", "speed", "torque", "wear", "failure")
    quality = PF.null_profile(s)
    params = PR.fit_impute(s.drop("key", "failure"), "auto")
    s = PR.apply_impute(s, params)
    nums = [c for c in ("air_temp", "proc_temp", "speed", "torque", "wear") if c in s.columns]
    folder = work_dir(spark, "preprocess")
    quality.write.parquet(f"{folder}/quality")
    PR.count_outside(s, PR.fit_bounds(s, nums, "iqr")).write.parquet(f"{folder}/outliers")  # report only: data unchanged
    s = PR.onehot(s, "type", PR.fit_levels(s, "type"), drop_first=True).drop("type")
    s = PR.apply_scaler(s, PR.fit_scaler(s, nums, "standard"))
    PR.split_stratified(s, "failure", "key", 0.2, 0.1).write.partitionBy("split").parquet(f"{folder}/splits")
    return round_doubles(spark.read.parquet(f"{folder}/splits"))


# ---------------------------------------------------------------- selection loops
def _eng(spark, sf):
    return model_frame(spark, sf, extended=True)


@query("select_rfe")
def q_select_rfe(spark, sf):
    """Recursive elimination with a random forest down to 5 features; rankings."""
    e = _eng(spark, sf)
    rk = FO.rfe(spark, train_bins(e, ENG), ENG, 5, trees=FOREST)
    e.unpersist()
    return spark.createDataFrame([(f, int(r)) for f, r in rk], "feature string, ranking int")


@query("select_rfecv")
def q_select_rfecv(spark, sf):
    """Elimination one feature at a time inside each of 5 folds, every size scored by
    the positive class's F1 on the held-out fold; the best size refitted on the training rows."""
    e = _eng(spark, sf)
    chosen, rows = FO.rfecv(spark, train_bins(e, ENG), [ENG], FOLDS, trees=FOREST)[0]
    for r in rows:
        best = r["size"] == len(chosen)
        r.update(size=float(r["size"]), verdict="best" if best else "", features=",".join(sorted(chosen)) if best else "")
    e.unpersist()
    return _metrics_df(spark, rows, ["size", "f1", "f1_std", "features", "verdict"])


@query("select_importance")
def q_select_importance(spark, sf):
    """Random-forest importances, top 5."""
    e = _eng(spark, sf)
    imp = ML.importances(M.pipeline("random_forest", ENG, n_estimators=FOREST, max_depth=8).fit(e.where("split = 'train'")), ENG)
    e.unpersist()
    return round_doubles(spark.createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(imp[:5])],
                                               "feature string, importance double, rank int"))


def _ranked(spark, sf, forest: FO.Forest):
    e = _eng(spark, sf)
    imp = FO.grow(spark, train_bins(e, ENG), [forest]).importances(0)
    e.unpersist()
    return round_doubles(spark.createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(imp[:5])], "feature string, importance double, rank int"))


@query("select_importance_extra_trees")
def q_select_importance_extra_trees(spark, sf):
    """Importances of 100 extremely randomised trees, top 5."""
    return _ranked(spark, sf, FO.Forest(tuple(ENG), trees=FOREST, depth=8, bootstrap=False, random_cuts=True))


@query("select_importance_tree")
def q_select_importance_tree(spark, sf):
    """Importances of a single tree, top 5."""
    return _ranked(spark, sf, FO.Forest(tuple(ENG), trees=1, depth=12, mtry=len(ENG), bootstrap=False))


def lasso_search(tr, cols):
    """Penalty, fit and a row per penalty of the path over the frame's folds."""
    return LN.lasso_cv(LN.moments(tr, cols, "label", "fold"))


@query("select_lasso")
def q_select_lasso(spark, sf):
    """L1-penalised regression on standardised features, the penalty chosen over a path of 100 by fold CV."""
    e = _eng(spark, sf)
    _, fit, _ = lasso_search(e.where("split = 'train'"), ENG)
    e.unpersist()
    return round_doubles(spark.createDataFrame([(f, v, v != 0) for f, v in fit.standardised.items()],
                                               "feature string, coefficient double, selected boolean"))


@query("select_lasso_path")
def q_select_lasso_path(spark, sf):
    """The path itself: penalty, held-out error and number of features left."""
    e = _eng(spark, sf)
    mom = LN.moments(e.where("split = 'train'"), ENG, "label", "fold")
    best, _, rows = LN.lasso_cv(mom)
    left = [sum(v != 0 for v in fit.standardised.values()) for _, fit in LN.lasso_path(mom)]
    e.unpersist()
    return round_doubles(spark.createDataFrame([(i + 1, r["alpha"], r["mse"], r["mse_std"], n, r["alpha"] == best)
                                                for i, (r, n) in enumerate(zip(rows, left))],
                                               "step int, alpha double, mse double, mse_std double, n_features int, best boolean"))


def _sequential(spark, sf, direction):
    d = model_frame(spark, sf)
    path = ML.sequential(d.where("split = 'train'"), ["air_temp", "proc_temp", "speed", "torque", "wear"], 3, FOLDS, direction)
    d.unpersist()
    return round_doubles(spark.createDataFrame([(i + 1, f, s) for i, (f, s) in enumerate(path)],
                                               "step int, feature string, f1 double"))


@query("select_sequential")
def q_select_sequential(spark, sf):
    """Greedy forward selection (logistic, 5-fold F1 of the positive class) of 3 of the five sensors."""
    return _sequential(spark, sf, "forward")


@query("select_sequential_backward")
def q_select_sequential_backward(spark, sf):
    """Greedy backward elimination down to 3 of the five sensors, scored as forward."""
    return _sequential(spark, sf, "backward")


def _corr_keep(e, cols, t):
    long = ST.corr_long(e, cols)
    return [r["feature"] for r in ST.select_correlation(long, cols, t).where("kept").orderBy("position").collect()]


def _importance_top(e, cols, k):
    imp = ML.importances(M.pipeline("random_forest", cols, n_estimators=FOREST, max_depth=6).fit(e), cols)
    return [f for f, _ in imp[:k]]


def hybrid_start(tr, cols, rank):
    """L12 up to its last stage: correlation 0.9 -> variance 0.01 -> importance (``rank`` of the remaining features)."""
    c1 = _corr_keep(tr, cols, 0.9)
    return rank([r["feature"] for r in ST.select_variance(tr, c1, 0.01).where("kept").collect()])


@query("select_hybrid")
def q_select_hybrid(spark, sf):
    """Correlation 0.9 -> variance 0.01 -> importance (2 x size) -> cross-validated elimination."""
    e = _eng(spark, sf)
    tr = e.where("split = 'train'")
    size = ST.target_size(tr.count(), len(ENG))
    start = hybrid_start(tr, ENG, lambda cols: _importance_top(tr, cols, 2 * size))
    chosen = FO.rfecv(spark, train_bins(e, ENG), [start], FOLDS, trees=FOREST)[0][0]
    e.unpersist()
    return spark.createDataFrame([(i + 1, f) for i, f in enumerate(chosen)], "position int, feature string")


@query("select_aggressive")
def q_select_aggressive(spark, sf):
    """Correlation 0.7 -> importance (size)."""
    e = _eng(spark, sf)
    tr = e.where("split = 'train'")
    size = ST.target_size(tr.count(), len(ENG))
    chosen = _importance_top(tr, _corr_keep(tr, ENG, 0.7), size)
    e.unpersist()
    return spark.createDataFrame([(i + 1, f) for i, f in enumerate(chosen)], "position int, feature string")


_ENG_SQL = {
    "temp_difference": "proc_temp - air_temp",
    "mechanical_power": "torque*(speed*2*pi()/60)",
    "wear_torque_interaction": "wear*torque/100",
    "stress_index": "(speed/nullif(op.max_speed, 0) + torque/nullif(op.max_torque, 0) + wear/nullif(op.max_wear, 0))/3",
    "speed_torque_ratio": "speed/nullif(torque + 1e-6, 0)",
}
_L14_SQL = X.with_sql(X.SENSOR_SQL + """,
op AS (SELECT max(speed) AS max_speed, max(torque) AS max_torque, max(wear) AS max_wear FROM sensor),
tr0 AS (SELECT s.*, CAST(type = 'L' AS INTEGER) AS type_L, CAST(type = 'M' AS INTEGER) AS type_M, """ + ", ".join(
    f"{v} AS {k}" for k, v in _ENG_SQL.items()) + """,
  row_number() OVER (PARTITION BY failure ORDER BY """ + _H + """, key) - 1 AS r, count(*) OVER (PARTITION BY failure) AS n
  FROM sensor s, op),
tr AS (SELECT * FROM tr0 WHERE r >= floor(n*0.2 + 0.5)),
m AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{x}' AS feature, failure AS cls, count({x}) AS n, avg({x}) AS mean, var_samp({x}) AS var, "
    f"(SELECT var_samp({x}) FROM tr) AS v_all FROM tr GROUP BY failure" for x in ENG) + """),
f AS (SELECT feature, ((sum(n*mean*mean) - sum(n*mean)*sum(n*mean)/sum(n))/(count(*) - 1))
        / (sum((n - 1)*coalesce(var, 0))/(sum(n) - count(*))) AS f_stat FROM m WHERE v_all > 0.001 GROUP BY feature)""",
    """SELECT feature, round(f_stat, 6) AS f_stat, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY f_stat DESC NULLS LAST, feature) AS rank FROM f)
  WHERE rank <= greatest(5, least(CAST(floor(sqrt((SELECT count(*) FROM tr))) AS BIGINT), (SELECT count(*) FROM tr) // 10, """
    + str(len(ENG)) + """ // 2))""")


@query("select_conservative", _L14_SQL)
def q_select_conservative(spark, sf):
    """Variance 0.001 -> ANOVA F top (size)."""
    from pyspark.sql.window import Window

    e = _eng(spark, sf)
    tr = e.where("split = 'train'")
    size = ST.target_size(tr.count(), len(ENG))
    keep = [r["feature"] for r in ST.select_variance(tr, ENG, 0.001).where("kept").collect()]
    f = ST.anova_f(ST.group_moments(tr, keep, "label"))
    f = f.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("f_stat"), "feature")))
    out = round_doubles(f.where(F.col("rank") <= size).select("feature", "f_stat", F.col("rank").cast("int")))
    return out


def evaluate_sets(spark, bins, sets):
    """5-fold F1 of the positive class (mean, population std) of a random forest per non-empty feature set, all grown together."""
    full = {k: v for k, v in sets.items() if v}
    scores = FO.fold_scores(spark, bins, list(full.values()), FOLDS, trees=FOREST)
    return [{"feature_set": k, "method": k, "f1": statistics.fmean(s), "f1_std": statistics.pstdev(s), "size": float(len(v)),
             "features": ",".join(v)} for (k, v), s in zip(full.items(), scores)]


@query("evaluate_feature_sets")
def q_evaluate_feature_sets(spark, sf):
    """Fold F1 of a random forest per feature set; empty sets are skipped."""
    e = _eng(spark, sf)
    sets = {"baseline": BASE, "temperature_focus": BASE + ["temp_difference", "mechanical_power"],
            "wear_focus": BASE + ["wear_torque_interaction", "stress_index"],
            "operational_focus": BASE + ["stress_index", "speed_torque_ratio"], "all": ENG, "empty": []}
    rows = evaluate_sets(spark, train_bins(e, ENG), sets)
    e.unpersist()
    return _metrics_df(spark, rows, ["feature_set", "size", "f1", "f1_std"])


@query("compare_selections")
def q_compare_selections(spark, sf):
    """The nine selection methods' feature sets, evaluated as in L16, saved and read back.
    The rankings grow together, then both eliminations, then all sets' folds."""
    e = _eng(spark, sf)
    tr = e.where("split = 'train'")
    size, bins = ST.target_size(tr.count(), len(ENG)), train_bins(e, ENG)
    uni = ST.anova_f(ST.group_moments(tr, ENG, "label")).orderBy(F.desc_nulls_last("f_stat"), "feature").limit(size)
    ranked: dict[tuple, list[str]] = {}
    stage2 = hybrid_start(tr, ENG, lambda cols: cols)
    narrow = _corr_keep(tr, ENG, 0.7)
    asked = list(dict.fromkeys(map(tuple, (ENG, stage2, narrow))))
    grown = FO.grow(spark, bins, [FO.Forest(cols, trees=FOREST) for cols in asked])
    ranked = {cols: [f for f, _ in grown.importances(i)] for i, cols in enumerate(asked)}
    (rfe, _), (mixed, _) = FO.rfecv(spark, bins, [ENG, ranked[tuple(stage2)][:2 * size]], FOLDS, trees=FOREST)
    lasso = lasso_search(tr, ENG)[1].standardised
    sets = {
        "all_features": ENG,
        "correlation": _corr_keep(tr, ENG, 0.9),
        "variance": [r["feature"] for r in ST.select_variance(tr, ENG, 0.01).where("kept").collect()],
        "univariate": [r["feature"] for r in uni.collect()],
        "importance": ranked[tuple(ENG)][:size],
        "rfe": rfe,
        "lasso": [f for f, w in lasso.items() if w != 0],
        "hybrid": mixed,
        "aggressive": ranked[tuple(narrow)][:size],
    }
    path = work_dir(spark, "selections")
    _metrics_df(spark, evaluate_sets(spark, bins, sets), ["method", "size", "f1", "f1_std", "features"]).coalesce(1).write.parquet(path)
    e.unpersist()
    return spark.read.parquet(path)


# ---------------------------------------------------------------- V14, V21, S12, R1
@query("bootstrap_ci")
def q_bootstrap_ci(spark, sf):
    """1000 bootstrap replicates of the stand-in scorer's confusion cells; 95 % intervals."""
    return round_doubles(ML.bootstrap_ci(V.binary_cells(X.scored(spark, sf)), 1000))


@query("importance")
def q_importance(spark, sf):
    """Random-forest importances of the engineered features, sorted, top 10."""
    e = _eng(spark, sf)
    imp = ML.importances(M.pipeline("random_forest", ENG, n_estimators=FOREST, max_depth=8).fit(e.where("split = 'train'")), ENG)
    e.unpersist()
    return round_doubles(spark.createDataFrame([(f, v) for f, v in imp[:10]], "feature string, importance double"))


def _trained(spark, sf):
    d = model_frame(spark, sf)
    model = M.pipeline("random_forest", BASE, n_estimators=FOREST, max_depth=6).fit(d.where("split = 'train'"))
    return d, model


@query("model_persist")
def q_model_persist(spark, sf):
    """Fitted pipeline written to the shared work folder, read back, and the test
    predictions of both compared (mismatch count must be 0)."""
    d, model = _trained(spark, sf)
    path = work_dir(spark, "model")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    te = d.where("split = 'test'")
    a = model.transform(te).select("key", F.col("prediction").alias("a"))
    b = back.transform(te).select("key", F.col("prediction").alias("b"))
    return a.join(b, "key").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a") != F.col("b")).alias("mismatches"))


@query("score_batch")
def q_score_batch(spark, sf):
    """Readings the model has not seen (the test split) -> levels and one-hot columns as fitted
    on the training rows -> fitted pipeline -> probability, confidence, risk level and action."""
    d, model = _trained(spark, sf)
    s = X.sensor(spark, sf)
    rows = lambda part: s.join(d.where(F.col("split") == part).select("key"), "key", "left_semi")
    s = PR.onehot(rows("test"), "type", PR.fit_levels(rows("train"), "type"), drop_first=True)
    aligned = RL.align_to_model(s, BASE, keep=["key"])
    pred = model.transform(aligned)
    out = pred.select("key", F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("p"))
    out = R.annotate(out, p="p", prediction="prediction")
    return round_doubles(out)
