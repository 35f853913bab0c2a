import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vigil.operators import profile as A


def _frame(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.0, 3.0, 7.0, 8.0, 20.0], "g": ["a", "a", "b", "b", "c", "c", "c"]})
    return spark.createDataFrame(pdf), pdf


def test_describe_matches_pandas(spark):
    df, pdf = _frame(spark)
    r = A.describe(df, ["x"]).first()
    d = pdf["x"].describe()
    for k, v in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                 ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert abs(r[k] - d[v]) < 1e-12


def test_bias_corrected_moments_match_pandas(spark):
    df, pdf = _frame(spark)
    m = A.feature_metadata(df, ["x"]).first()
    assert abs(m["skew"] - pdf["x"].skew()) < 1e-12
    assert abs(m["kurtosis"] - pdf["x"].kurt()) < 1e-12


def test_mode_ties_smallest_and_categorical(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "v string")
    r = A.describe_categorical(df, ["v"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (4, 2, "a", 2)


def test_duplicates(spark):
    rows = [(i, float(i)) for i in range(5)] * 3
    df = spark.createDataFrame(rows, "a long, b double")
    assert A.duplicate_count(df).first()["duplicates"] == 10


def test_crosstab_margins(spark):
    df = spark.createDataFrame([("L", 0), ("L", 1), ("M", 0)], "t string, y int")
    out = {(r["t"], r["y"]): r["count"] for r in A.crosstab(df, "t", "y").collect()}
    assert out[("All", "All")] == 3 and out[("L", "All")] == 2 and out[("All", "0")] == 2


def test_histogram_top_edge_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    h = {r["bin"]: r["count"] for r in A.histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 11 and h[4] == 3  # 8, 9, 10


def test_empty_frame_aggregates(spark):
    df = spark.createDataFrame([], "x double, g string")
    r = A.describe(df, ["x"]).first()
    assert r["count"] == 0 and r["mean"] is None
    assert A.duplicate_count(df).first()["duplicates"] == 0


def test_class_balance_single_class(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    r = A.class_balance(df, "y").first()
    assert r["classes"] == 1 and r["imbalance_ratio"] == 1.0
