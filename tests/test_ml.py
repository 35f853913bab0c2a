import numpy as np
from pyspark.sql import functions as F

from vigil.operators import ml as ML
from vigil.operators import evaluation as V


def test_knn_block_path_equals_broadcast_path(spark, sf, monkeypatch):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label")
    a = ML.knn(e, e, "vec_id", "vec_id", "embedding", "label", k=5, exclude_self=True)
    monkeypatch.setattr(ML, "KNN_BROADCAST_BYTES", 10)
    b = ML.knn(e, e, "vec_id", "vec_id", "embedding", "label", k=5, exclude_self=True, block_rows=200)
    assert a.count() == e.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bootstrap_interval_contains_point_estimate(spark):
    cells = spark.createDataFrame([(400, 100, 100, 400, 1000)], "tn long, fp long, fn long, tp long, n long")
    r = ML.bootstrap_ci(cells, 200).first()
    assert r["replicates"] == 200 and r["accuracy_lo"] <= 0.8 <= r["accuracy_hi"]


def _selection_frame(spark, n=600):
    rows = []
    for i in range(n):
        a, b, c = (i * 37 % 101) / 101, (i * 53 % 97) / 97, (i * 71 % 89) / 89
        rows.append((i, float(a + 0.3 * b > 0.8), a, b, c, 0.0, i % 5))
    return spark.createDataFrame(rows, "key long, label double, strong double, weak double, noise double, flat double, fold int").cache()


def test_rfecv_scores_every_size_on_held_out_folds(spark):
    from vigil.operators import ml as ML

    df = _selection_frame(spark)
    chosen, rows = ML.rfecv(df, ["strong", "weak", "noise", "flat"], k=2, trees=3, depth=3)
    assert [r["size"] for r in rows] == [1, 2, 3, 4]
    best = max(rows, key=lambda r: (r["f1"], -r["size"]))
    assert len(chosen) == best["size"] and "strong" in chosen
    # the score of the full size, by hand
    by_hand = [ML.fit_evaluate(ML._forest(["strong", "weak", "noise", "flat"], "label", 3, 3, 42), df.where(f"fold <> {f}"), df.where(f"fold = {f}"),
                               auc=False)[1]["f1_1"] for f in (0, 1)]
    assert abs(rows[-1]["f1"] - sum(by_hand) / 2) < 1e-12


def test_rfe_ranks_one_per_step(spark):
    from vigil.operators import ml as ML

    rk = ML.rfe(_selection_frame(spark), ["strong", "weak", "noise", "flat"], 1, trees=3)
    assert sorted(r for _, r in rk) == [1, 2, 3, 4] and rk[0][0] == "strong"


def test_sequential_directions(spark):
    from vigil.operators import ml as ML

    df = _selection_frame(spark)
    fwd = ML.sequential(df, ["strong", "weak", "noise"], 1, k=2, max_iter=20)
    back = ML.sequential(df, ["strong", "weak", "noise"], 1, 2, "backward", max_iter=20)
    assert fwd[0][0] == "strong" and len(back) == 2 and "strong" not in [f for f, _ in back]


def test_folds_of_the_data_reach_the_search(spark):
    from pyspark.ml.tuning import ParamGridBuilder

    from vigil.operators import ml as ML
    from vigil.plans import models as M

    df = _selection_frame(spark)
    seen = []
    cv = ML.cross_validate(lambda n: seen.append(n) or M.pipeline("logistic", ["strong", "weak"], n_rows=n, max_iter=20), df, 5, metric="f1_1")
    assert seen == [480] * 5 and len(cv["scores"]) == 5
    pipe = M.pipeline("decision_tree", ["strong", "weak"])
    grid = ParamGridBuilder().addGrid(pipe.getStages()[-1].maxDepth, [1, 3]).build()
    assert len(ML.grid_search(pipe, grid, df).avgMetrics) == 2


def test_metrics_of_any_number_of_classes(spark):
    from vigil.operators import evaluation as V

    rows = [("a", "a", 0.9, 0.1, 0.0), ("a", "b", 0.4, 0.5, 0.1), ("b", "b", 0.2, 0.7, 0.1), ("c", "b", 0.1, 0.6, 0.3), ("c", "c", 0.1, 0.1, 0.8),
            (None, "c", 0.3, 0.3, 0.4)]
    df = spark.createDataFrame(rows, "y string, yhat string, pa double, pb double, pc double")
    rep = {r["class"]: r for r in V.class_report(V.confusion_long(df)).collect()}
    assert (rep["b"]["precision"], rep["b"]["recall"], rep["b"]["support"]) == (1 / 3, 1.0, 1) and rep[None]["recall"] == 0.0
    s = V.class_summary(V.class_report(V.confusion_long(df))).first()
    assert abs(s["accuracy"] - 0.5) < 1e-12 and abs(s["weighted_recall"] - 0.5) < 1e-12
    auc = {r["class"]: r["auc"] for r in V.roc_auc_ovr(df, {"a": "pa", "b": "pb", "c": "pc"}).collect()}
    assert auc["a"] == 1.0 and abs(auc["c"] - 7 / 8) < 1e-12 and auc["b"] == 1.0


def test_regression_metrics_with_a_large_mean(spark):
    import numpy as np

    from vigil.operators import evaluation as V

    y = 1e9 + np.arange(200) * 0.01
    p = y + np.sin(np.arange(200))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, yhat double")
    r = V.regression_metrics(df).first()
    assert abs(r["r2"] - (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-4
    assert abs(r["median_ae"] - np.median(np.abs(y - p))) < 1e-9
