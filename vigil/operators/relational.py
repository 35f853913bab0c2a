"""Projections, predicates and key joins.

Rows are identified by an explicit key everywhere; position alignment of the
source becomes an equi-join on that key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.roles import RAW_TO_ROLE, clean_name
from vigil.operators.profile import NUMERIC, c

LEAKAGE = ["failure", "twf", "hdf", "pwf", "osf", "rnf", "key", "product_id"]
# Gates used by the readiness checks.
GATES = {"accuracy": 0.85, "precision": 0.80, "recall": 0.85, "f1": 0.82}


def select_by_type(df: DataFrame, kind: str = "numeric") -> DataFrame:
    """Numeric / string / boolean subsets of the columns."""
    want = {"numeric": NUMERIC, "string": (T.StringType,), "boolean": (T.BooleanType,)}[kind]
    return df.select(*[c(f.name) for f in df.schema.fields if isinstance(f.dataType, want)])


def rename_cols(df: DataFrame, mapping: dict[str, str] | None = None, clean: bool = False) -> DataFrame:
    """Rename by mapping (default: raw display names -> roles), or clean names."""
    if clean:
        return df.toDF(*[clean_name(x) for x in df.columns])
    mapping = mapping if mapping is not None else RAW_TO_ROLE
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_leakage(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Drop the target, the failure modes and ids from a feature frame."""
    drop = [x for x in LEAKAGE + (extra or []) if x in df.columns]
    out = df.drop(*drop)
    assert not set(drop) & set(out.columns)
    return out


def features_target(df: DataFrame, target: str, features: list[str] | None = None, key: str | None = None) -> DataFrame:
    """Key + features + target; unknown names raise."""
    if target not in df.columns:
        raise KeyError(f"target {target!r} not in frame")
    feats = features if features is not None else [x for x in df.columns if x not in (target, key)]
    missing = [x for x in feats if x not in df.columns]
    if missing:
        raise KeyError(f"features not in frame: {missing}")
    return df.select(*([c(key)] if key else []), *[c(x) for x in feats], c(target))


def ensure_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Non-numeric columns coerced to double, failures -> NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = cols or [x for x in df.columns if not isinstance(types[x], NUMERIC)]
    return df.withColumns({x: c(x).try_cast("double") for x in cols})


def align_to_model(df: DataFrame, trained: list[str], strict: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Select the trained feature list; absent -> 0.0 and extra ones left out (lenient), or raise on either (strict)."""
    missing = [x for x in trained if x not in df.columns]
    extra = [x for x in df.columns if x not in trained and x not in (keep or [])]
    if strict and (missing or extra):
        raise ValueError(f"feature mismatch: missing {missing}, extra {extra}")
    return df.select(*[c(k) for k in keep or []],
                     *[(c(x) if x in df.columns else F.lit(0.0)).alias(x) for x in trained])


def validate_inputs(df: DataFrame, features: list[str], target: str | None = None) -> DataFrame:
    """One aggregate of violation counts -> (check, column, count) rows with count > 0.

    Checks: empty frame, NULL / NaN / +-inf per feature, NULL target, fewer
    than two classes, non-numeric target.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, x in enumerate(features):
        v = c(x).cast("double")
        aggs += [F.count_if(c(x).isNull()).alias(f"z{i}"), F.count_if(F.isnan(v)).alias(f"nan{i}"),
                 F.count_if(F.abs(v) == float("inf")).alias(f"inf{i}")]
    if target:
        aggs += [F.count_if(c(target).isNull()).alias("_tz"), F.count_distinct(c(target)).alias("_tk")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit("empty").alias("check"), F.lit(None).cast("string").alias("column"),
                     F.when(F.col("_n") == 0, 1).otherwise(0).cast("long").alias("count"))]
    for i, x in enumerate(features):
        rows += [F.struct(F.lit("null").alias("check"), F.lit(x).alias("column"), F.col(f"z{i}").alias("count")),
                 F.struct(F.lit("nan").alias("check"), F.lit(x).alias("column"), F.col(f"nan{i}").alias("count")),
                 F.struct(F.lit("infinite").alias("check"), F.lit(x).alias("column"), F.col(f"inf{i}").alias("count"))]
    if target:
        numeric = isinstance(types[target], NUMERIC)
        rows += [F.struct(F.lit("null_target").alias("check"), F.lit(target).alias("column"), F.col("_tz").alias("count")),
                 F.struct(F.lit("single_class").alias("check"), F.lit(target).alias("column"),
                          F.when(F.col("_tk") < 2, 1).otherwise(0).cast("long").alias("count")),
                 F.struct(F.lit("non_numeric_target").alias("check"), F.lit(target).alias("column"),
                          F.lit(0 if numeric else 1).cast("long").alias("count"))]
    return wide.select(F.inline(F.array(*rows))).where(F.col("count") > 0)


def filter_gate(metrics: DataFrame, gates: dict = GATES) -> DataFrame:
    """P10: models meeting every gate (inclusive)."""
    cond = F.lit(True)
    for m, g in gates.items():
        cond = cond & (c(m) >= g)
    return metrics.where(cond)


def filter_discrepancies(df: DataFrame, target: str, modes: list[str]) -> DataFrame:
    """Rows whose target differs from the OR of the modes."""
    return df.where(c(target) != F.greatest(*[c(m) for m in modes]))


# ---------------------------------------------------------------- joins
def concat_columns(left: DataFrame, right: DataFrame, key: str, how: str = "full") -> DataFrame:
    """Index-aligned concatenation = equi-join on the key (full outer keeps both sides)."""
    shared = [x for x in right.columns if x in left.columns and x != key]
    return left.join(right.drop(*shared), key, how)


def align_target(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows present in both (index intersection)."""
    return features.join(target, key, "inner")


def merge_feature_sets(base: DataFrame, eng: DataFrame, key: str, mode: str = "drop") -> DataFrame:
    """J3: 'drop' / 'keep_first' keep the base copy of shared names; 'suffix' prefixes both sides."""
    if mode in ("drop", "keep_first"):
        shared = [x for x in eng.columns if x in base.columns and x != key]
        return base.join(eng.drop(*shared), key, "inner")
    if mode == "suffix":
        b = base.select(c(key), *[c(x).alias(f"baseline_{x}") for x in base.columns if x != key])
        e = eng.select(c(key), *[c(x).alias(f"engineered_{x}") for x in eng.columns if x != key])
        return b.join(e, key, "inner")
    raise ValueError(f"unknown merge mode {mode!r}")


def join_labels(pred: DataFrame, truth: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Predictions paired with truth on the key, and the unmatched predictions (anti join)."""
    return pred.join(truth, key, "inner"), pred.join(truth, key, "left_anti")


def join_train_eval(train: DataFrame, evaluation: DataFrame, on: str = "model_name") -> DataFrame:
    """Training and evaluation record per model."""
    return train.join(evaluation, on, "full")
