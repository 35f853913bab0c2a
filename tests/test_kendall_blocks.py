import numpy as np

from test_stats_eval import _brute_tau_b
from vigil.operators import stats as ST


def test_kendall_frequent_y_fills_no_group(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.permutation(1200) / 7.0
    y = (x + rng.normal(0, 60, 1200) > 80).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    count = ST._discordant

    def bounded(first, second, n):
        assert len(n) <= 200, len(n)
        return count(first, second, n)

    monkeypatch.setattr(ST, "_discordant", bounded)
    assert abs(ST.kendall_tau_b(df, "x", "y", 100) - _brute_tau_b(x, y)) < 1e-12
