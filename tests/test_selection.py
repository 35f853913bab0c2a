import numpy as np
import pytest

from vigil.functions.ordering import fit_quantiles
from vigil.functions.selection import exact_quantiles, ordered_bits

PROBS = [0.0, 0.1, 1 / 3, 0.5, 0.77, 1.0]


def test_order_of_the_bits():
    x = np.array([-np.inf, -1e300, -1.5, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.5, 1e300, np.inf])
    b = ordered_bits(x)
    assert (np.diff(b.astype(object)) >= 0).all() and b[5] == b[6] and (np.diff(b.astype(object)) > 0).sum() == 10


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_the_percentile_aggregate(spark, parts):
    rnd = np.random.default_rng(1)
    n = 3000
    cols = [rnd.normal(0, 1, n), rnd.integers(-3, 4, n).astype(float), np.exp(rnd.normal(0, 40, n)), 1e9 + rnd.random(n), np.zeros(n)]
    rows = [tuple(None if (i + j) % 11 == 0 else float("nan") if (i + 2 * j) % 13 == 0 else float(c[i]) for j, c in enumerate(cols)) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, `c c` double, d double, e double").repartition(parts)
    clean = df.selectExpr(*[f"CASE WHEN NOT isnan(`{x}`) THEN `{x}` END AS `{x}`" for x in df.columns])
    want = {x: list(clean.selectExpr(f"percentile(`{x}`, array({', '.join(map(repr, PROBS))}))").first()[0]) for x in df.columns}
    assert exact_quantiles(df, df.columns, PROBS) == want


def test_no_values_and_one(spark):
    df = spark.createDataFrame([(None, 2.0, float("nan")), (None, None, None)], "a double, b double, c double")
    assert exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5]) == {"a": [None, None], "b": [2.0, 2.0], "c": [None, None]}
    assert exact_quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}


def test_binning_counts_no_distinct_values(spark, monkeypatch):
    from vigil.operators import forest

    df = spark.createDataFrame([(float(i % 17), float(i) / 7) for i in range(500)], "a double, b double")
    want = {x: sorted({float(v) for v in q}) for x, q in fit_quantiles(df, ["a", "b"], [i / 31 for i in range(1, 31)]).items()}
    monkeypatch.setattr(type(df), "agg", lambda *a, **k: (_ for _ in ()).throw(AssertionError("one aggregate holds all distinct values")))
    assert forest.fit_cuts(df, ["a", "b"]) == want
