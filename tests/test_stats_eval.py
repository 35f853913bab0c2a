import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.functions.ordering import grouped_prefix
from vigil.operators import evaluation as V
from vigil.operators import stats as ST


def test_incomplete_beta_constants():
    # two-sided t p for t=2, nu=10, and F upper tail for F=3, d=(2, 27)
    assert abs(ST.betainc(5.0, 0.5, 10 / (10 + 4))[()] - 0.0733880) < 1e-6
    assert abs(ST.betainc(13.5, 1.0, 27 / (27 + 6))[()] - 0.0665998) < 1e-6


def test_normal_quantile():
    assert abs(ST.normal_quantile(0.975) - 1.959963985) < 1e-8
    assert abs(ST.normal_quantile(0.5)) < 1e-12


def _brute_tau_b(x, y):
    n = len(x)
    c = d = tx = ty = 0
    for i, j in itertools.combinations(range(n), 2):
        sx, sy = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        if sx * sy > 0:
            c += 1
        elif sx * sy < 0:
            d += 1
    n0 = n * (n - 1) / 2
    n1 = sum(v * (v - 1) / 2 for v in pd.Series(x).value_counts())
    n2 = sum(v * (v - 1) / 2 for v in pd.Series(y).value_counts())
    return (c - d) / math.sqrt((n0 - n1) * (n0 - n2))


def test_kendall_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, 80).astype(float)
    y = (x + rng.integers(0, 4, 80)).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    assert abs(ST.kendall_tau_b(df, "x", "y") - _brute_tau_b(x, y)) < 1e-12


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.integers(0, 10, 200).astype(float), "b": rng.normal(size=200)})
    r = ST.corr_spearman(spark.createDataFrame(pdf), ["a", "b"]).first()["r"]
    ranks = pdf.rank(method="average")
    assert abs(r - ranks["a"].corr(ranks["b"])) < 1e-12


def _auc_brute(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_tied_scores_vs_brute_force(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400) * 0.3 + y * 0.2, 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y.astype(int), "p": p, "yhat": (p >= 0.5).astype(int)}))
    assert abs(V.roc_auc(df).first()["auc"] - _auc_brute(y, p)) < 1e-12


def test_equal_scores_and_single_class(spark):
    df = spark.createDataFrame([(0, 0.5, 1), (1, 0.5, 1), (1, 0.5, 1)], "y int, p double, yhat int")
    assert V.roc_auc(df).first()["auc"] == 0.5
    pr = V.pr_curve(df).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)
    one = spark.createDataFrame([(0, 0.2, 0), (0, 0.3, 0)], "y int, p double, yhat int")
    assert V.roc_auc(one).first()["auc"] is None
    m = V.class_metrics(V.binary_cells(one)).first()
    assert m["accuracy"] == 1.0 and m["precision_1"] == 0.0  # 0/0 -> 0


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_grouped_prefix_matches_cumsum(spark, buckets):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 300), "o": rng.permutation(300), "w": rng.integers(0, 5, 300)})
    out = grouped_prefix(spark.createDataFrame(pdf), ["g"], ["o"], ["w"], n_buckets=buckets).toPandas()
    pdf = pdf.sort_values(["g", "o"])
    pdf["exp"] = pdf.groupby("g")["w"].cumsum() - pdf["w"]
    got = out.set_index(["g", "o"])["w_before"]
    assert (got.loc[list(zip(pdf["g"], pdf["o"]))].to_numpy() == pdf["exp"].to_numpy()).all()


def test_cost_models(spark):
    cells = spark.createDataFrame([(90, 5, 2, 3, 100)], "tn long, fp long, fn long, tp long, n long")
    a = V.cost_failure_model(cells).first()
    assert a["total_cost"] == 5 * 500 + 2 * 8000 + 8 * 1000 and a["total_value"] == 3 * 10000 - a["total_cost"]
    b = V.cost_downtime_model(cells).first()
    assert b["baseline_cost"] == 100 * 10000 and b["production_loss"] == 8 * 4 * 5000
    c = V.cost_matrix_model(cells).first()
    assert c["total_cost"] == 3 * -100 + 90 * -10 + 5 * 500 + 2 * 5000 and abs(c["detection_rate"] - 0.6) < 1e-12


def test_readiness_gates_and_recommendations(spark):
    m = spark.createDataFrame([("a", 0.9, 0.85, 0.9, 0.83, 60.0), ("b", 0.8, 0.7, 0.9, 0.83, 10.0)],
                              "model_name string, accuracy double, precision double, recall double, f1 double, roi double")
    r = {x["model_name"]: x for x in V.readiness(m).collect()}
    assert r["a"]["ready_for_production"] and not r["b"]["ready_for_production"]
    recs = V.recommendations(V.readiness(m)).collect()
    assert [x["recommendation"] for x in recs if x["model_name"] == "a"] == [V.RECOMMENDATIONS["ok"]]
    assert len([x for x in recs if x["model_name"] == "b"]) == 3  # accuracy, precision, roi


def test_distributed_exact_quantiles_match_numpy(spark):
    from vigil.functions.ordering import exact_quantiles_distributed, fit_quantiles

    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=3000), rng.integers(0, 4, 2000).astype(float)])
    pdf = pd.DataFrame({"x": x, "g": rng.integers(0, 3, len(x))})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    for method in ("distributed", "exact"):
        got = fit_quantiles(df, ["x"], probs, method)["x"]
        assert np.allclose(got, np.quantile(x, probs), rtol=0, atol=1e-12)
    g = exact_quantiles_distributed(df, "x", [0.25, 0.5], by=["g"]).toPandas()
    for _, r in g.iterrows():
        assert abs(r["value"] - pdf[pdf.g == r["g"]].x.quantile(r["prob"])) < 1e-12


def test_kendall_many_distinct_values_in_blocks(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.exponential(3, 1500), 3)
    y = np.round(x + rng.normal(0, 2, 1500), 2)
    x[:300], y[200:500] = 1.5, -0.25  # heavy ties
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0)], "x double, y double")
    want = _brute_tau_b(x, y)
    for cells in (200_000, 300, 40):
        assert abs(ST.kendall_tau_b(df, "x", "y", cells) - want) < 1e-12
