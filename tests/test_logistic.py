import numpy as np
import pytest

from vigil.operators import forest as FO
from vigil.operators import logistic as X
from vigil.operators import ml as ML
from vigil.plans import models as M


def frame(spark, n=900):
    rnd = np.random.default_rng(5)
    a, b, d = rnd.normal(300, 4, n), rnd.normal(0, 1, n), rnd.normal(50, 10, n)
    y = (a - 300) / 4 + 0.5 * b + rnd.normal(0, 1, n) > 0.8
    return spark.createDataFrame([(i, float(t), *map(float, r), i % 3) for i, (t, r) in enumerate(zip(y, zip(a, b, d)))],
                                 "key long, label double, a double, b double, d double, fold int")


def test_models_together_score_as_single_fits(spark):
    df, sets = frame(spark).cache(), [["a"], ["b", "d"], ["a", "b", "d"]]
    cells = X.fold_cells(df, sets, 3)
    assert cells.sum() == 3 * 900
    for s, mine in zip(sets, cells):
        want = ML.cross_validate(lambda n, f=s: M.pipeline("logistic", f, n_rows=n), df, 3, metric="f1_1")["scores"]
        assert np.allclose([FO.metrics(c)["f1_1"] for c in mine], want, atol=1e-9)


def test_a_round_of_candidates_is_a_few_passes(spark, monkeypatch):
    passes = []
    once = X._pass
    monkeypatch.setattr(X, "_pass", lambda *a: passes.append(len(a[-1])) or once(*a))
    monkeypatch.setattr(ML, "cross_validate", lambda *a, **k: (_ for _ in ()).throw(AssertionError("one fit per candidate and fold")))
    path = ML.sequential(frame(spark), ["a", "b", "d"], 2, 3)
    assert [f for f, _ in path] == ["a", "b"] and passes[0] == 9 and len(passes) < 30


def test_one_class_no_rows_and_constants(spark):
    ddl = "label double, a double, b double, fold int"
    one = spark.createDataFrame([(0.0, float(i), 1.0, i % 2) for i in range(10)], ddl)
    assert X.fold_cells(one, [["a"], ["b"]], 2)[:, :, 0, 0].sum() == 20
    assert X.fold_cells(one.limit(0), [["a"]], 2).sum() == 0
    gap = spark.createDataFrame([(float(i > 5), None if i == 8 else float(i), 1.0, i % 2) for i in range(12)], ddl)
    with pytest.raises(ValueError, match="null, NaN"):
        X.fold_cells(gap, [["a", "b"]], 2)
    assert X.fold_cells(gap.na.drop(), [["a", "b"]], 2).sum() == 11
