"""Missing values, outliers, encoding, scaling, splits (M, O, E, D).

Each learned step is ``fit_*`` -> small parameter dict (one aggregate) and
``apply_*`` -> column expressions with the parameters as literals.  Row-order
operations (fills, interpolation) run in windows partitioned by a series key.
Splits and folds use a deterministic integer hash and an exact per-class rank
computed in two levels (bucket prefix counts + a rank inside each bucket), so
no class ever lands in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.functions.ordering import dense_rank0, fit_quantiles, null_safe_join
from vigil.operators.profile import NUMERIC, c, numeric_columns, quantiles

# ============================================================== M missing values


def fit_impute(df: DataFrame, strategy: str = "auto", cols: list[str] | None = None,
               drop_threshold: float = 0.5, method: str = "exact") -> dict:
    """Fill values per column from one aggregate.

    auto: null share > threshold -> drop; numeric -> median; other -> mode
    (smallest value on ties).  mean / median: numeric columns only.  mode:
    every column.
    """
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, x in enumerate(cols):
        num = isinstance(types[x], NUMERIC)
        aggs.append(F.count_if(c(x).isNull()).alias(f"z{i}"))
        if strategy == "mean" and num:
            aggs.append(F.avg(c(x)).alias(f"v{i}"))
        elif strategy in ("median", "auto") and num:
            pass  # medians come from fit_quantiles below
    row = df.agg(*aggs).first().asDict()
    modes = [(i, x) for i, x in enumerate(cols) if strategy == "mode" or (strategy == "auto" and not isinstance(types[x], NUMERIC))]
    row.update({f"v{i}": v for (i, _), v in zip(modes, column_modes(df, [x for _, x in modes]))})
    n = row["_n"]
    med_cols = [x for x in cols if strategy in ("median", "auto") and isinstance(types[x], NUMERIC)]
    med = fit_quantiles(df, med_cols, [0.5], method) if med_cols else {}
    for i, x in enumerate(cols):
        if x in med:
            row[f"v{i}"] = med[x][0]
    fill, drop = {}, []
    for i, x in enumerate(cols):
        if strategy == "auto" and n and row[f"z{i}"] / n > drop_threshold:
            drop.append(x)
            continue
        if row.get(f"v{i}") is not None and row[f"z{i}"] > 0:
            fill[x] = row[f"v{i}"]
    return {"fill": fill, "drop": drop}


def column_modes(df: DataFrame, cols: list[str]) -> list:
    """Most frequent non-null value per column, the smallest on ties.  Values are
    counted by distributed grouping, one column of the unpivoted pair (type,
    value) each; no task holds all distinct values of a column."""
    out = []
    for kind in dict.fromkeys(df.schema[x].dataType.simpleString() for x in cols):
        mine = [x for x in cols if df.schema[x].dataType.simpleString() == kind]
        long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), c(x).alias("v")) for i, x in enumerate(mine)])).alias("e")).select("e.*")
        counts = long.where(F.col("v").isNotNull()).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
        top = counts.groupBy("i").agg(F.max("n").alias("n"))
        first = counts.join(F.broadcast(top), ["i", "n"]).groupBy("i").agg(F.min("v").alias("v"))  # one row per column
        found = {r["i"]: r["v"] for r in first.collect()}
        out += [(x, found.get(i)) for i, x in enumerate(mine)]
    by = dict(out)
    return [by[x] for x in cols]


def apply_impute(df: DataFrame, params: dict) -> DataFrame:
    out = df.drop(*params["drop"])
    types = {f.name: f.dataType for f in out.schema.fields}
    cols = {x: F.coalesce(c(x), F.lit(v).cast(types[x])) for x, v in params["fill"].items() if x in types}
    return out.withColumns(cols) if cols else out


def impute_drop(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """M2: drop rows with any null."""
    return df.na.drop("any", subset=cols)


def ffill(df: DataFrame, cols: list[str], series: str, order: list[str], n_chunks: int | None = None) -> DataFrame:
    """M5: last non-null value in row order within each series; leading nulls stay.

    Skew-safe: a series is cut into order-preserving chunks and the last known
    value crosses chunk borders through a small per-chunk table
    (``vigil.functions.series``), so a hot machine is not one task."""
    from vigil.functions import series as SR

    return SR.ffill(df, cols, series, order, n_chunks)


def interpolate(df: DataFrame, cols: list[str], series: str, order: list[str], n_chunks: int | None = None) -> DataFrame:
    """M6: linear interpolation by row position within each series.

    Leading nulls stay null; trailing nulls take the last known value.  Same
    chunked evaluation as ``ffill`` (positions from per-chunk counts)."""
    from vigil.functions import series as SR

    return SR.interpolate(df, cols, series, order, n_chunks)


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """M7: NaN and NULL -> 0."""
    return df.withColumns({x: F.coalesce(F.nanvl(c(x).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
                           for x in cols})


# ============================================================== O outliers


def fit_bounds(df: DataFrame, cols: list[str], method: str = "iqr", factor: float = 1.5, ddof: int = 1,
               qmethod: str = "exact") -> dict[str, tuple[float, float]]:
    """Lower / upper bound per column: iqr (Q1 - kIQR, Q3 + kIQR), zscore
    (mean -+ k std), percentile (k-th and (100-k)-th percentiles)."""
    if method == "iqr":
        q = fit_quantiles(df, cols, [0.25, 0.75], qmethod)
    elif method == "percentile":
        q = fit_quantiles(df, cols, [factor / 100, 1 - factor / 100], qmethod)
    elif method == "zscore":
        sd = (lambda v: F.stddev_samp(v)) if ddof == 1 else (lambda v: F.stddev_pop(v))
        row = df.agg(*[F.array(F.avg(c(x).cast("double")), sd(c(x).cast("double"))).alias(x) for x in cols]).first()
        q = {x: row[x] for x in cols}
    else:
        raise ValueError(f"unknown outlier method {method!r}")
    out = {}
    for i, x in enumerate(cols):
        a, b = q[x] or (None, None)
        if a is None or b is None:
            out[x] = (None, None)
        elif method == "iqr":
            out[x] = (a - factor * (b - a), b + factor * (b - a))
        elif method == "zscore":
            out[x] = (a - factor * b, a + factor * b)
        else:
            out[x] = (a, b)
    return out


def count_outside(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """One aggregate: per column count of values outside the bounds (long form)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    cols = list(bounds)
    for i, x in enumerate(cols):
        lo, hi = bounds[x]
        aggs.append(F.count_if((c(x) < F.lit(lo)) | (c(x) > F.lit(hi))).alias(f"o{i}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(x).alias("column"), F.lit(bounds[x][0]).cast("double").alias("lower"),
                     F.lit(bounds[x][1]).cast("double").alias("upper"), F.col(f"o{i}").alias("outliers"),
                     F.try_divide(F.col(f"o{i}") * 100.0, F.col("_n")).alias("outlier_pct")) for i, x in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def zscore_outliers(df: DataFrame, cols: list[str], threshold: float = 3.0, ddof: int = 1) -> DataFrame:
    """O2: count of |z| > threshold per column (sample std by default, ddof=0 population)."""
    aggs = []
    for i, x in enumerate(cols):
        sd = F.stddev_samp(c(x)) if ddof == 1 else F.stddev_pop(c(x))
        aggs += [F.avg(c(x)).alias(f"m{i}"), sd.alias(f"s{i}")]
    row = df.agg(*aggs).first()
    aggs2 = []
    for i, x in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        z = F.abs(F.try_divide(c(x) - F.lit(m), F.lit(s).cast("double")))
        aggs2.append(F.count_if(z > threshold).alias(f"o{i}"))
    wide = df.agg(*aggs2)
    rows = [F.struct(F.lit(x).alias("column"), F.lit(row[f"m{i}"]).cast("double").alias("mean"),
                     F.lit(row[f"s{i}"]).cast("double").alias("std"), F.col(f"o{i}").alias("outliers"))
            for i, x in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def clip(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Values clipped into the fitted bounds; nulls stay null."""
    return df.withColumns({x: F.when(c(x).isNull(), c(x)).otherwise(
        F.greatest(F.least(c(x), F.lit(hi)), F.lit(lo))) for x, (lo, hi) in bounds.items()})


# ============================================================== E encoding / scaling


def fit_levels(df: DataFrame, col: str, max_levels: int = 10_000) -> list:
    """Sorted distinct non-null values; refuses more than ``max_levels`` (use
    ``label_index`` for unbounded cardinality)."""
    d = df.select(c(col).alias("v")).where(F.col("v").isNotNull()).distinct()
    vals = [r["v"] for r in d.limit(max_levels + 1).collect()]
    if len(vals) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    return sorted(vals)


def onehot(df: DataFrame, col: str, levels: list, drop_first: bool = False, prefix: str | None = None) -> DataFrame:
    """``prefix_level`` 0/1 columns from a fitted level list."""
    prefix = prefix or col
    use = levels[1:] if drop_first else levels
    return df.withColumns({f"{prefix}_{lv}": (c(col) == F.lit(lv)).cast("int") for lv in use})


def label_codes_small(col: Column, levels: list) -> Column:
    """E2 for a bounded level list: code = index in the sorted levels."""
    e = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, lv in enumerate(sorted(levels)):
        e = e.when(col == F.lit(lv), F.lit(i))
    return e


def fit_label_index(df: DataFrame, col: str) -> DataFrame:
    """E2 for any cardinality: (value, code) table, code = index in sorted distinct values."""
    d = df.select(c(col).alias(col)).where(c(col).isNotNull()).distinct()
    return dense_rank0(d, [col])


def fit_first_appearance(df: DataFrame, col: str, order: str) -> DataFrame:
    """(value, code) by first appearance in ``order``."""
    first = df.where(c(col).isNotNull()).groupBy(c(col).alias(col)).agg(F.min(order).alias("_first"))
    return dense_rank0(first, ["_first", col]).drop("_first")


def apply_codes(df: DataFrame, codes: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Join the code table; AQE broadcasts it if its measured size is small."""
    out = out or f"{col}_code"
    right = codes.select(c(col).alias("_v"), F.col("code").alias(out))
    return df.join(right, c(col) == F.col("_v"), "left").drop("_v")


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "standard", quantile_range=(25.0, 75.0),
               method: str = "exact") -> dict[str, tuple[float, float]]:
    """(center, scale) per column: standard (mean, population std), minmax
    (min, max - min), robust (median, Q_hi - Q_lo).  A zero scale becomes 1."""
    if kind == "robust":
        lo, hi = quantile_range[0] / 100, quantile_range[1] / 100
        q = fit_quantiles(df, cols, [0.5, lo, hi], method)
        row = {}
        for i, x in enumerate(cols):
            m, a, b = q[x]
            row[f"a{i}"], row[f"b{i}"] = m, (b - a) if a is not None and b is not None else None
    else:
        aggs = []
        for i, x in enumerate(cols):
            v = c(x).cast("double")
            if kind == "standard":
                aggs += [F.avg(v).alias(f"a{i}"), F.stddev_pop(v).alias(f"b{i}")]
            elif kind == "minmax":
                aggs += [F.min(v).alias(f"a{i}"), (F.max(v) - F.min(v)).alias(f"b{i}")]
            else:
                raise ValueError(f"unknown scaler {kind!r}")
        row = df.agg(*aggs).first()
    return {x: (row[f"a{i}"], row[f"b{i}"] if row[f"b{i}"] not in (None, 0, 0.0) else 1.0)
            for i, x in enumerate(cols)}


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({x: (c(x) - F.lit(a)) / F.lit(float(b)) for x, (a, b) in params.items()})


def scale_params_table(spark, params: dict[str, tuple[float, float]]) -> DataFrame:
    """Parameters as a k-row table (persisted with the experiment)."""
    return spark.createDataFrame([(k, float(a) if a is not None else None, float(b)) for k, (a, b) in params.items()],
                                 "column string, center double, scale double")


# ============================================================== D splits and folds

HASH_MOD = 998244353
HASH_MUL = 2654435761
HASH_SPACE = 4294967296
HASH_MIX = 73244475


def split_hash(key: Column, seed: int = 42) -> Column:
    """32-bit hash in integer arithmetic that DuckDB has too: h = ((key mod
    998244353) * 2654435761 + seed) mod 2^32, then two rounds of ``h = (h xor h >>
    16) * 73244475 mod 2^32`` and a last xor.  The rounds are one to one and not
    linear, so orders under two seeds have nothing in common."""
    h = (F.pmod(key, F.lit(HASH_MOD)) * F.lit(HASH_MUL) + F.lit(seed)) % F.lit(HASH_SPACE)
    fold = lambda x: x.bitwiseXOR(F.shiftright(x, 16))
    for _ in range(2):
        h = (fold(h) * F.lit(HASH_MIX)) % F.lit(HASH_SPACE)
    return fold(h)


def split_hash_sql(key: str = "key", seed: int = 42) -> str:
    """DuckDB twin of :func:`split_hash` for keys of 0 or more."""
    h = f"(({key} % {HASH_MOD})*{HASH_MUL} + {seed}) % {HASH_SPACE}"
    for _ in range(2):
        h = f"list_transform([{h}], lambda h: (xor(h, h >> 16)*{HASH_MIX}) % {HASH_SPACE})[1]"
    return f"list_transform([{h}], lambda h: xor(h, h >> 16))[1]"


def class_rank(df: DataFrame, cls: str | None, key: str, seed: int = 42, bucket_bits: int = 16) -> DataFrame:
    """Adds ``_h`` and the exact 0-based rank ``_rank`` of each row inside its
    class by (h, key), plus the class size ``_n``.

    Level 1: rows fall into 2^bucket_bits hash buckets (the top bits of h); a
    (class, bucket) count table gives each bucket's offset inside its class.
    Level 2: rows are ranked inside their (class, bucket) only, so a window
    group holds about n / 2^bucket_bits rows.  No sizing pass over the input:
    the count table is joined plainly and AQE broadcasts it when it is small.
    """
    cls_col = c(cls) if cls else F.lit(0)
    d = df.withColumn("_cls", cls_col).withColumn("_h", split_hash(c(key), seed))
    d = d.withColumn("_b", F.shiftright(F.col("_h"), 32 - bucket_bits))
    cnt = d.groupBy("_cls", "_b").agg(F.count(F.lit(1)).alias("_bc"))
    w = Window.partitionBy("_cls").orderBy("_b")
    cnt = cnt.select("_cls", "_b", F.coalesce(F.sum("_bc").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)).alias("_off"),
                     F.sum("_bc").over(Window.partitionBy("_cls")).alias("_n"))
    d = null_safe_join(d, cnt, ["_cls", "_b"])  # rows without a class (or key) are a class (bucket) of their own
    inner = Window.partitionBy("_cls", "_b").orderBy("_h", c(key))
    d = d.withColumn("_rank", F.col("_off") + F.row_number().over(inner) - 1)
    return d.drop("_b", "_off")


def split_stratified(df: DataFrame, target: str | None, key: str, test: float = 0.2, val: float = 0.1,
                     seed: int = 42) -> DataFrame:
    """``split`` in {train, val, test}; test is the first round(n_c * test)
    rows of each class in hash order, val the next round((n_c - n_test) * val / (1 - test))."""
    d = class_rank(df, target, key, seed)
    n_test = F.floor(F.col("_n") * test + 0.5)
    n_val = F.floor((F.col("_n") - n_test) * (val / (1 - test)) + 0.5) if val > 0 else F.lit(0)
    split = F.when(F.col("_rank") < n_test, "test").when(F.col("_rank") < n_test + n_val, "val").otherwise("train")
    return d.withColumn("split", split).drop("_cls", "_h", "_rank", "_n")


def kfold(df: DataFrame, target: str | None, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """D2 (target given: stratified) / D3 (target None): fold = rank mod k."""
    d = class_rank(df, target, key, seed)
    return d.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_cls", "_h", "_rank", "_n")


def split_and_fold(df: DataFrame, target: str, key: str, test: float = 0.2, k: int = 3, seed: int = 42) -> DataFrame:
    """D1 + D2 from one class ranking: ``split`` (train / test) and, on every
    row, ``fold`` = rank mod k (folds are used on the training rows)."""
    d = class_rank(df, target, key, seed)
    n_test = F.floor(F.col("_n") * test + 0.5)
    return d.withColumns({"split": F.when(F.col("_rank") < n_test, "test").otherwise("train"),
                          "fold": (F.col("_rank") % k).cast("int")}).drop("_cls", "_h", "_rank", "_n")
