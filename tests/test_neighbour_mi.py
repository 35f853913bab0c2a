import math

import numpy as np
import pytest

from vigil.operators import stats as ST


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def plain(x, y, k=3):
    size = {c: y.count(c) for c in set(y)}
    at = [i for i in range(len(x)) if size[y[i]] > 1]
    total = 0.0
    for i in at:
        d = sorted(abs(x[j] - x[i]) for j in at if j != i and y[j] == y[i])
        ki = min(k, size[y[i]] - 1)
        r = d[ki - 1]
        m = sum(abs(x[j] - x[i]) < r if r > 0 else x[j] == x[i] for j in at)
        ki = ki if r > 0 else sum(x[j] == x[i] and y[j] == y[i] for j in at)
        total += psi(ki) - psi(size[y[i]]) - psi(m)
    return max(0.0, psi(len(at)) + total / len(at))


def test_digamma(spark):
    got = spark.range(1, 2000).select("id", ST.digamma(__import__("pyspark").sql.functions.col("id")).alias("p")).collect()
    assert all(abs(r.p - psi(r.id)) < 1e-10 for r in got)


@pytest.mark.parametrize("block", [1, 50, 4096])
def test_equals_all_pairs(spark, block):
    rnd = np.random.default_rng(2)
    n = 260
    y = [int(v) for v in rnd.integers(0, 3, n)] + [9]  # a class of one row
    grid = [float(v) for v in rnd.integers(0, 12, n + 1)]  # many ties
    even = [float(2 ** -4 * round(16 * (v + c))) for v, c in zip(rnd.normal(0, 1, n + 1), y)]  # exact differences
    noise = [float(v) / 1024 for v in rnd.integers(0, 10**6, n + 1)]
    rows = list(zip(y, grid, even, noise)) + [(None, 1.0, 1.0, 1.0), (1, None, float("nan"), None)]
    df = spark.createDataFrame(rows, "cls int, grid double, even double, noise double").repartition(3)
    got = {r.feature: r.mutual_info for r in ST.neighbour_mutual_info(df, ["grid", "even", "noise"], "cls", block=block).collect()}
    for name, x in (("grid", grid), ("even", even), ("noise", noise)):
        assert got[name] == pytest.approx(plain(x, y), abs=1e-9), name


def test_information_of_a_copy_and_of_nothing(spark):
    df = spark.createDataFrame([(i % 2, float(i % 2) + (i % 7) / 64, None) for i in range(400)], "cls int, copy double, none double")
    got = {r.feature: r.mutual_info for r in ST.neighbour_mutual_info(df, ["copy", "none"], "cls").collect()}
    assert abs(got["copy"] - math.log(2)) < 0.02 and got["none"] is None
