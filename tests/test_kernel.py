import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import kernel as KN


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(1)
    n = 2000
    y, a = np.arange(n) % 2, rng.uniform(0, 2 * math.pi, n)
    r = np.where(y == 1, 3.0, 1.0) + rng.normal(0, 0.2, n)
    return spark.createDataFrame(list(zip((r * np.cos(a)).tolist(), (10 * r * np.sin(a)).tolist(), y.tolist())), "a double, b double, y int")


def test_rings_are_told_apart_where_a_line_cannot(spark, rings):
    train, test = rings.where("pmod(hash(a), 4) > 0"), rings.where("pmod(hash(a), 4) = 0")
    model = KN.fit(train, ["a", "b"], "y")
    right = KN.predict(test, model).agg(F.avg(((F.col("margin") > 0).cast("int") == F.col("y")).cast("int"))).first()[0]
    assert right > 0.98
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import VectorAssembler

    line = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    flat = LinearSVC(labelCol="y").fit(line.transform(train)).transform(line.transform(test))
    assert flat.where("prediction = y").count() / test.count() < 0.7


def test_weights_are_a_minimum_and_do_not_depend_on_partitions(rings):
    one, many = KN.fit(rings.repartition(1), ["a", "b"], "y", count=16), KN.fit(rings.repartition(7), ["a", "b"], "y", count=16)
    assert np.allclose(one.landmarks, many.landmarks) and len(one.landmarks) == 16
    assert np.allclose(one.weights, many.weights, rtol=1e-6, atol=1e-8)
    data = rings.toPandas()
    z, sign = one.features(data[["a", "b"]].to_numpy()), np.where(data.y > 0, 1.0, -1.0)

    def plain(w):
        return w[:-1] @ w[:-1] / 2 + (np.maximum(0, 1 - sign * (z @ w)) ** 2).sum()

    best = plain(one.weights)
    rng = np.random.default_rng(2)
    for size in (1e-3, 1e-2, 1e-1):
        assert all(plain(one.weights + size * rng.normal(size=z.shape[1])) > best for _ in range(20))
    full = KN._kernel(one.landmarks, one.landmarks, one.gamma)
    back = one.features(one.landmarks * one.scale + one.centre)[:, :-1]
    assert np.allclose(back @ back.T, full, atol=1e-6)


def test_regression_follows_a_sine(spark):
    x = np.linspace(-6, 6, 1500)
    df = spark.createDataFrame(list(zip(x.tolist(), np.sin(x).tolist())), "x double, y double")
    model = KN.fit(df, ["x"], "y", cost=10.0, epsilon=0.05, gamma=3.0)
    off = KN.predict(df, model, "f").agg(F.max(F.abs(F.col("f") - F.col("y")))).first()[0]
    assert off < 0.12


def test_edge_cases(spark):
    rows = [(1.0, None, 0), (None, 2.0, 1), (float("nan"), 1.0, 1), (1.0, 5.0, 0), (2.0, 5.0, 1), (2.0, 5.0, 1), (3.0, 5.0, None)]
    df = spark.createDataFrame(rows, "`a.b` double, flat double, y int").withColumn("margin", F.lit("own"))
    model = KN.fit(df, ["a.b", "flat"], "y")
    assert len(model.landmarks) == 2
    got = KN.predict(df, model).collect()
    assert [r.margin is None for r in got] == [True, True, True, False, False, False, False]
    assert got[3].margin < 0 < got[4].margin
    empty = KN.fit(df.limit(0), ["a.b", "flat"], "y")
    assert {r.margin for r in KN.predict(df, empty).collect()} == {None, 0.0}
    assert KN.predict(df.limit(0), model).collect() == []
