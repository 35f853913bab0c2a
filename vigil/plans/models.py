"""Estimator factories (G1-G8, G12, T10) on ``pyspark.ml``.

Every factory returns an unfitted ``Pipeline`` whose first stages assemble
(and, for scale-sensitive models, standardise) the feature columns, so the
fitted ``PipelineModel`` carries its own preprocessing to scoring time.
"""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALED = {"logistic", "svm", "svr", "mlp", "linear", "ridge", "lasso"}


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = sqrt(2 / D) cos(W x + b) with W ~ N(0, 2 gamma), b ~ U(0, 2 pi)
    (Rahimi and Recht, 2007): an explicit map whose inner products approximate
    the RBF kernel, so a linear SVM on z approximates the kernel SVM."""

    weights = Param(Params._dummy(), "weights", "flattened D x p projection", TypeConverters.toListFloat)
    offsets = Param(Params._dummy(), "offsets", "D phase offsets", TypeConverters.toListFloat)
    dim = Param(Params._dummy(), "dim", "input dimension p", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="rff", weights=None, offsets=None, dim=1):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, weights=weights or [], offsets=offsets or [], dim=dim)

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector, vector_to_array

        w, b, p = self.getOrDefault("weights"), self.getOrDefault("offsets"), self.getOrDefault("dim")
        d = len(b)
        x = vector_to_array(F.col(self.getInputCol()))
        scale = math.sqrt(2.0 / d)
        comps = []
        for j in range(d):
            dot = F.lit(b[j])
            for i in range(p):
                dot = dot + F.lit(w[j * p + i]) * x[i]
            comps.append(F.lit(scale) * F.cos(dot))
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*comps)))


def rff_stage(df: DataFrame, cols: list[str], n_components: int = 50, gamma: float | str = "scale",
              seed: int = 42) -> RandomFourierFeatures:
    """Draws the random map; gamma='scale' = 1 / (p var(X)) on the standardised input (var = 1)."""
    import numpy as np

    p = len(cols)
    g = 1.0 / p if gamma == "scale" else float(gamma)
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * g), size=(n_components, p))
    b = rng.uniform(0, 2 * math.pi, size=n_components)
    return RandomFourierFeatures("scaled", "rff", [float(v) for v in w.ravel()], [float(v) for v in b], p)


def estimator(name: str, label: str = "label", features: str = "features", **kw) -> Estimator:
    """Registry of the model families (G-rows) with parameter mapping."""
    seed = kw.pop("seed", 42)
    if name == "logistic":
        c, n = kw.pop("C", 1.0), kw.pop("n_rows", 1)
        l1 = kw.pop("penalty", "l2") == "l1"
        return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (c * max(n, 1)),
                                  elasticNetParam=1.0 if l1 else 0.0, standardization=False,
                                  maxIter=kw.pop("max_iter", 100), **kw)
    if name == "random_forest":
        return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=kw.pop("n_estimators", 100),
                                      maxDepth=min(kw.pop("max_depth", 10) or 30, 30), seed=seed, **kw)
    if name == "rf_regressor":
        return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=kw.pop("n_estimators", 100),
                                     maxDepth=min(kw.pop("max_depth", 10) or 30, 30), seed=seed, **kw)
    if name == "decision_tree":
        return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=kw.pop("max_depth", 10),
                                      impurity=kw.pop("criterion", "gini"), seed=seed, **kw)
    if name == "gbt":
        return GBTClassifier(featuresCol=features, labelCol=label, maxIter=kw.pop("n_estimators", 50),
                             maxDepth=kw.pop("max_depth", 5), stepSize=kw.pop("learning_rate", 0.1), seed=seed, **kw)
    if name == "gbt_regressor":
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=kw.pop("n_estimators", 50),
                            maxDepth=kw.pop("max_depth", 5), stepSize=kw.pop("learning_rate", 0.1), seed=seed, **kw)
    if name == "svm":
        c = kw.pop("C", 1.0)
        return LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / max(c, 1e-12) / max(kw.pop("n_rows", 1), 1),
                         maxIter=kw.pop("max_iter", 100), **kw)
    if name in ("svr",):
        return LinearRegression(featuresCol=features, labelCol=label, loss="huber", regParam=kw.pop("alpha", 0.0), **kw)
    if name == "linear":
        return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, standardization=False, **kw)
    if name == "ridge":
        a, n = kw.pop("alpha", 1.0), kw.pop("n_rows", 1)
        return LinearRegression(featuresCol=features, labelCol=label, regParam=a / max(n, 1), elasticNetParam=0.0,
                                standardization=False, **kw)
    if name == "lasso":
        return LinearRegression(featuresCol=features, labelCol=label, regParam=kw.pop("alpha", 1.0), elasticNetParam=1.0,
                                standardization=False, **kw)
    if name == "mlp":
        return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=kw.pop("layers"),
                                              maxIter=kw.pop("max_iter", 100), seed=seed, **kw)
    raise ValueError(f"unknown model {name!r}")


def pipeline(name: str, cols: list[str], label: str = "label", rff: RandomFourierFeatures | None = None, **kw) -> Pipeline:
    """Assembler (+ standardiser for scale-sensitive families, + RFF for the rbf SVM) + estimator."""
    stages = [VectorAssembler(inputCols=cols, outputCol="raw", handleInvalid="keep")]
    if name in SCALED:
        stages.append(StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True))
        feats = "scaled"
        if rff is not None:
            stages.append(rff)
            feats = "rff"
    else:
        feats = "raw"
    if name == "mlp" and "layers" not in kw:
        kw["layers"] = [len(cols) if rff is None else len(rff.getOrDefault("offsets")), 16, 8, 2]
    stages.append(estimator(name, label=label, features=feats, **kw))
    return Pipeline(stages=stages)


# Suites (T10): name -> (family, preset parameters).
BASELINE_SUITE = {
    "logistic_regression": ("logistic", {"max_iter": 100}),
    "random_forest": ("random_forest", {"n_estimators": 100, "max_depth": 8}),
    "decision_tree": ("decision_tree", {"max_depth": 10}),
    "gradient_boosting": ("gbt", {"n_estimators": 20, "max_depth": 4}),
}
OPTIMIZED_SUITE = {
    "random_forest_tuned": ("random_forest", {"n_estimators": 100, "max_depth": 12}),
    "gradient_boosting_tuned": ("gbt", {"n_estimators": 40, "max_depth": 5, "learning_rate": 0.05}),
}
