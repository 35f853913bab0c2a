"""Correlation, statistical tests and closed-form feature selection (C, L).

Pairwise statistics come from one wide ``agg`` (k(k-1)/2 ``corr``s) or, for
many columns, from ``pyspark.ml.stat.Correlation`` (one Gramian pass).  Ranks
for Spearman are computed per distinct value with distributed prefix sums and
joined back.  p-values are evaluated on the k-row result with a vectorised
regularised incomplete beta (continued fraction) inside a pandas UDF.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vigil.functions.ordering import bucket_of, fit_quantiles, grouped_prefix
from vigil.operators.profile import c, quantiles
from vigil.functions.cache import keep


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


# ---------------------------------------------------------------- C1 / C2
def corr_long(df: DataFrame, cols: list[str], full: bool = False) -> DataFrame:
    """Pearson correlation, long form (a, b, r) for i < j; ``full`` adds the
    mirrored pairs and the unit diagonal.  Pairwise-complete: each pair uses
    the rows where both values are present (as ``corr`` does)."""
    pairs = _pairs(cols)
    wide = df.agg(*[F.corr(c(a).cast("double"), c(b).cast("double")).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)]
    if full:
        rows += [F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"r{k}").alias("r"))
                 for k, (a, b) in enumerate(pairs)]
        rows += [F.struct(F.lit(a).alias("a"), F.lit(a).alias("b"), F.lit(1.0).alias("r")) for a in cols]
    return wide.select(F.inline(F.array(*rows)))


def average_rank_table(df: DataFrame, col: str) -> DataFrame:
    """(value, average rank) for the distinct non-null values of ``col`` (ties share the mean rank)."""
    vc = df.where(c(col).isNotNull()).groupBy(c(col).alias("_v")).agg(F.count(F.lit(1)).alias("_cnt"))
    vc = grouped_prefix(vc, [], ["_v"], ["_cnt"])
    return vc.select("_v", (F.col("_cnt_before") + (F.col("_cnt") + 1) / 2.0).alias("_rank"))


def with_average_ranks(df: DataFrame, cols: list[str], suffix: str = "_rank") -> DataFrame:
    """Joins each column's (value, average rank) table back.  The tables have one
    row per distinct value; the join is left to AQE, which broadcasts a table
    only when its measured size is under the broadcast threshold."""
    out = df
    for x in cols:
        t = average_rank_table(df, x)
        out = out.join(t, c(x) == F.col("_v"), "left").withColumnRenamed("_rank", f"{x}{suffix}").drop("_v")
    return out


def corr_spearman(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson on average ranks (rows with a null in a pair are skipped by ``corr``).
    The projected input is cached: it feeds one rank table per column and the final pass."""
    r = with_average_ranks(keep(df.select(*cols)), cols)
    out = corr_long(r, [f"{x}_rank" for x in cols])
    return out.select(F.regexp_replace("a", "_rank$", "").alias("a"), F.regexp_replace("b", "_rank$", "").alias("b"), "r")


# ---------------------------------------------------------------- C3 Kendall
def kendall_tau_b(df: DataFrame, x: str, y: str, block_cells: int = 200_000) -> float:
    """Exact tau-b by a distributed merge count.

    The distinct (x, y) cells are cut into about ``cells / block_cells`` ranges
    of x and of y.  A discordant pair lies in different ranges of both (counted
    on the table of range counts), in one range of y (counted inside that
    range) or in one range of x (counted inside it).  Ties come from grouped
    counts.  A value that fills a range by itself has a range of its own."""
    d = df.select(c(x).cast("double").alias("x"), c(y).cast("double").alias("y")).na.drop()
    cells = keep(d.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")))
    pairs = lambda col: F.sum((col * (col - 1) / 2).cast("decimal(38,0)"))
    both = cells.agg(F.sum("n").alias("n"), pairs(F.col("n")).alias("t"), F.count(F.lit(1)).alias("k")).first()
    if not both["n"]:
        return float("nan")
    n0 = both["n"] * (both["n"] - 1) // 2
    n1, n2 = (int(cells.groupBy(v).agg(F.sum("n").alias("n")).agg(pairs(F.col("n"))).first()[0]) for v in ("x", "y"))
    blocks = max(1, -(-both["k"] // block_cells))
    ranged = cells
    for v, b in (("x", "bx"), ("y", "by")):
        raw = sorted(cells.agg(F.percentile_approx(v, [i / blocks for i in range(1, blocks)], 10 * blocks)).first()[0]) if blocks > 1 else []
        cuts = sorted({e for q in raw for e in ((q, math.nextafter(q, -math.inf)) if raw.count(q) > 1 else (q,))})
        ranged = ranged.withColumn(b, bucket_of([v], cuts))

    table = ranged.groupBy("bx", "by").agg(F.sum("n").cast("decimal(38,0)").alias("n"))
    below = Window.partitionBy("by").orderBy("bx").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("bx").orderBy(F.col("by").desc()).rowsBetween(Window.unboundedPreceding, -1)
    size = {b: ranged.agg(F.max(b)).first()[0] for b in ("bx", "by")}
    every = df.sparkSession.range(size["bx"] + 1).select(F.col("id").alias("bx"), F.explode(F.sequence(F.lit(0), F.lit(size["by"]))).alias("by"))
    grid = every.join(table, ["bx", "by"], "left").na.fill(0, ["n"])  # ranges x ranges: their number is cells over block_cells
    earlier = grid.withColumn("e", F.coalesce(F.sum("n").over(below), F.lit(0).cast("decimal(38,0)")))
    apart = earlier.withColumn("h", F.coalesce(F.sum("e").over(above), F.lit(0).cast("decimal(38,0)")))
    disc = int(apart.agg(F.sum((F.col("n") * F.col("h")).cast("decimal(38,0)"))).first()[0] or 0)

    def inside(group: str, first: str):
        many = ranged.groupBy(group).agg(((F.min(first) < F.max(first)) & (F.min("y") < F.max("y"))).alias("m")).filter("m").select(group)  # else no pair counts

        def count(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"d": [str(_discordant(pdf[first].to_numpy(), pdf["y"].to_numpy(), pdf["n"].to_numpy()))]})

        got = ranged.select("x", "y", "bx", "by", "n").join(many, group).groupBy(group).applyInPandas(count, "d string")
        return int(got.agg(F.sum(F.col("d").cast("decimal(38,0)"))).first()[0] or 0)

    disc += inside("by", "bx") + inside("bx", "x")
    den = math.sqrt(n0 - n1) * math.sqrt(n0 - n2)
    return float((n0 - n1 - n2 + int(both["t"]) - 2 * disc) / den) if den > 0 else float("nan")


def _discordant(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> int:
    """Weighted pairs with ``first`` lower and ``second`` higher, bit by bit over
    the ranks of ``second``: inside a group of equal leading bits, a row with a
    0 next is discordant with the rows of lower ``first`` that have a 1."""
    order = np.argsort(first, kind="stable")
    first, second, n = first[order], np.unique(second, return_inverse=True)[1][order], n[order].astype(object if n.sum() > 2 ** 31 else np.int64)
    total = 0
    for bit in range(int(second.max()).bit_length() - 1, -1, -1):
        group = second >> (bit + 1)
        at = np.argsort(group, kind="stable")  # keeps the order by first
        g, f, one, w = group[at], first[at], (second[at] >> bit) & 1, n[at]
        run = np.concatenate(([0], np.cumsum(w * one)))
        new = np.concatenate(([True], g[1:] != g[:-1]))
        tie = new | np.concatenate(([True], f[1:] != f[:-1]))
        start = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
        head = np.maximum.accumulate(np.where(tie, np.arange(len(g)), 0))
        total += int((w * (one == 0) * (run[head] - run[start])).sum())
    return total


# ---------------------------------------------------------------- C4-C7
def corr_pairs(df: DataFrame, cols: list[str], threshold: float = 0.95) -> DataFrame:
    """C4: pairs with |r| > threshold and the member to drop (lower sample
    variance; a tie drops the second)."""
    long = corr_long(df, cols).where(F.abs("r") > threshold)
    var = df.agg(*[F.var_samp(c(x)).alias(x) for x in cols]).first().asDict()
    vmap = F.create_map(*[v for x in cols for v in (F.lit(x), F.lit(var[x]).cast("double"))])
    return long.withColumn("drop", F.when(vmap[F.col("a")] >= vmap[F.col("b")], F.col("b")).otherwise(F.col("a")))


def corr_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """|corr| with the target, ranked, with strength bands .3 / .5 / .7."""
    wide = df.agg(*[F.corr(c(x).cast("double"), c(target).cast("double")).alias(f"r{i}") for i, x in enumerate(cols)])
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"r{i}").alias("r"))
                                         for i, x in enumerate(cols)])))
    long = long.withColumn("abs_r", F.abs("r"))
    # one row per feature: a global window over a schema-sized result
    long = long.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("abs_r"), "feature")))
    return long.withColumn("strength", F.when(F.col("abs_r") >= 0.7, "strong").when(F.col("abs_r") >= 0.5, "moderate")
                           .when(F.col("abs_r") >= 0.3, "weak").otherwise("very weak"))


def corr_summary(long: DataFrame) -> DataFrame:
    """Distribution of the upper-triangle correlations."""
    return long.agg(F.count("r").alias("pairs"), F.avg(F.abs("r")).alias("mean_abs"), F.max(F.abs("r")).alias("max_abs"),
                    F.min("r").alias("min_r"), F.max("r").alias("max_r"),
                    F.count_if(F.abs("r") > 0.5).alias("above_05"), F.count_if(F.abs("r") > 0.7).alias("above_07"))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = slope x + intercept and r."""
    return df.agg(F.lit(x).alias("feature"), F.regr_slope(c(y), c(x)).alias("slope"),
                  F.regr_intercept(c(y), c(x)).alias("intercept"), F.corr(c(x), c(y)).alias("r"))


# ---------------------------------------------------------------- C8 tests
def group_moments(df: DataFrame, cols: list[str], by: str) -> DataFrame:
    """Per (feature, class): n, mean, sample variance - one grouped pass."""
    aggs = []
    for i, x in enumerate(cols):
        aggs += [F.count(c(x)).alias(f"n{i}"), F.avg(c(x)).alias(f"m{i}"), F.var_samp(c(x)).alias(f"v{i}")]
    g = df.groupBy(c(by).alias("cls")).agg(*aggs)
    return g.select("cls", F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"n{i}").alias("n"),
                                                       F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("var"))
                                             for i, x in enumerate(cols)])))


def anova_f(moments: DataFrame) -> DataFrame:
    """One-way F per feature from per-class moments (k classes, N rows)."""
    g = moments.groupBy("feature").agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("mean")).alias("sx"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("snm2"))
    ssb = F.col("snm2") - F.col("sx") * F.col("sx") / F.col("N")
    d1, d2 = F.col("k") - 1, F.col("N") - F.col("k")
    return g.select("feature", d1.alias("df1"), d2.alias("df2"),
                    F.try_divide(ssb / d1, F.col("ssw") / d2).alias("f_stat"))


def pooled_t(moments: DataFrame, classes=(0, 1)) -> DataFrame:
    """Two-sample pooled t per feature (class a minus class b)."""
    a, b = classes
    p = moments.groupBy("feature").pivot("cls", list(classes)).agg(F.first("n").alias("n"), F.first("mean").alias("m"),
                                                                   F.first("var").alias("v"))
    n1, n2 = F.col(f"{a}_n"), F.col(f"{b}_n")
    sp2 = ((n1 - 1) * F.col(f"{a}_v") + (n2 - 1) * F.col(f"{b}_v")) / (n1 + n2 - 2)
    t = F.try_divide(F.col(f"{a}_m") - F.col(f"{b}_m"), F.sqrt(sp2 * (1 / n1 + 1 / n2)))
    return p.select("feature", t.alias("t_stat"), (n1 + n2 - 2).alias("dof"))


def _betacf(a, b, x, iters=300, eps=1e-15):
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    cc = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        cc = 1.0 + aa / cc
        cc = np.where(np.abs(cc) < tiny, tiny, cc)
        d = 1.0 / d
        h *= d * cc
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        cc = 1.0 + aa / cc
        cc = np.where(np.abs(cc) < tiny, tiny, cc)
        d = 1.0 / d
        delta = d * cc
        h *= delta
        if np.all(np.abs(delta - 1.0) < eps):
            break
    return h


def betainc(a, b, x):
    """Regularised incomplete beta I_x(a, b) (continued fraction, Lentz)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    ok = (x >= 0) & (x <= 1) & (a > 0) & (b > 0)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        aa, bb, xx = a[mid], b[mid], x[mid]
        lbeta = np.array([math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q) for p, q in zip(aa, bb)])
        front = np.exp(np.log(xx) * aa + np.log1p(-xx) * bb - lbeta)
        direct = xx < (aa + 1) / (aa + bb + 2)
        res = np.empty_like(xx)
        if direct.any():
            res[direct] = front[direct] * _betacf(aa[direct], bb[direct], xx[direct]) / aa[direct]
        if (~direct).any():
            r = ~direct
            res[r] = 1.0 - front[r] * _betacf(bb[r], aa[r], 1.0 - xx[r]) / bb[r]
        out[mid] = res
    return out


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided p of Student t: I_x(nu/2, 1/2), x = nu / (nu + t^2)."""
    tt, nu = t.to_numpy(dtype=float), dof.to_numpy(dtype=float)
    return pd.Series(betainc(nu / 2, 0.5, nu / (nu + tt * tt)))


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Upper tail of F: I_x(d2/2, d1/2), x = d2 / (d2 + d1 F)."""
    ff, a, b = f.to_numpy(dtype=float), d1.to_numpy(dtype=float), d2.to_numpy(dtype=float)
    return pd.Series(betainc(b / 2, a / 2, b / (b + a * ff)))


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


# ---------------------------------------------------------------- C9 / C10
def jarque_bera(df: DataFrame, col: str) -> DataFrame:
    """JB from population skewness / excess kurtosis; p = exp(-JB / 2)."""
    g = df.agg(F.count(c(col)).alias("n"), F.skewness(c(col)).alias("skew"), F.kurtosis(c(col)).alias("kurt"))
    jb = F.col("n") / 6 * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / 4)
    return g.select(F.lit(col).alias("feature"), "n", "skew", "kurt", jb.alias("jb"), F.exp(-jb / 2).alias("p_value"))


# Coefficients of the rational normal-quantile approximation (Acklam).
_NQ_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00]
_NQ_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01]
_NQ_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00]
_NQ_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]


def normal_quantile(p: float) -> float:
    """Standard normal quantile (rational approximation, rel. error < 1.2e-9)."""
    lo = 0.02425
    if p < lo:
        q = math.sqrt(-2 * math.log(p))
        num = ((((_NQ_C[0] * q + _NQ_C[1]) * q + _NQ_C[2]) * q + _NQ_C[3]) * q + _NQ_C[4]) * q + _NQ_C[5]
        return num / ((((_NQ_D[0] * q + _NQ_D[1]) * q + _NQ_D[2]) * q + _NQ_D[3]) * q + 1)
    if p > 1 - lo:
        return -normal_quantile(1 - p)
    q = p - 0.5
    r = q * q
    num = (((((_NQ_A[0] * r + _NQ_A[1]) * r + _NQ_A[2]) * r + _NQ_A[3]) * r + _NQ_A[4]) * r + _NQ_A[5]) * q
    return num / (((((_NQ_B[0] * r + _NQ_B[1]) * r + _NQ_B[2]) * r + _NQ_B[3]) * r + _NQ_B[4]) * r + 1)


def qq_points(df: DataFrame, col: str, m: int = 20, method: str = "exact") -> DataFrame:
    """M sample quantiles at (i - 0.5) / m against the normal quantiles."""
    probs = [(i - 0.5) / m for i in range(1, m + 1)]
    theo = [normal_quantile(p) for p in probs]
    q = fit_quantiles(df, [col], probs, method)[col]
    rows = [(i + 1, p, t, float(v) if v is not None else None) for i, (p, t, v) in enumerate(zip(probs, theo, q))]
    return df.sparkSession.createDataFrame(rows, "i int, prob double, theoretical double, sample double")


# ---------------------------------------------------------------- C11 paired t
def paired_ttest(fold_scores: DataFrame, model: str = "model_name", fold: str = "fold", score: str = "score") -> DataFrame:
    """C11: every model pair (m1 < m2) - paired t on the per-fold score differences."""
    a = fold_scores.select(F.col(model).alias("model_a"), F.col(fold).alias("_f"), F.col(score).alias("_sa"))
    b = fold_scores.select(F.col(model).alias("model_b"), F.col(fold).alias("_f"), F.col(score).alias("_sb"))
    j = a.join(b, "_f").where(F.col("model_a") < F.col("model_b"))
    d = F.col("_sa") - F.col("_sb")
    g = j.groupBy("model_a", "model_b").agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("mean_diff"),
                                             F.stddev_samp(d).alias("sd_diff"))
    t = F.try_divide(F.col("mean_diff"), F.col("sd_diff") / F.sqrt(F.col("n")))
    return g.withColumn("t_stat", t).withColumn("dof", F.col("n") - 1)


def paired_verdict(pairs: DataFrame, alpha: float = 0.05) -> DataFrame:
    """C11: two-sided p-value, significance and the better model of each pair of ``paired_ttest``
    (equal means: none; no spread: p is 0 where the means differ)."""
    p = F.when(F.col("sd_diff") > 0, t_pvalue(F.coalesce("t_stat", F.lit(0.0)), F.col("dof").cast("double")))
    p = p.otherwise(F.when(F.col("mean_diff") == 0, 1.0).otherwise(0.0))
    better = F.when(F.col("mean_diff") > 0, F.col("model_a")).when(F.col("mean_diff") < 0, F.col("model_b"))
    return pairs.withColumns({"p_value": p, "better_model": better}).withColumn("significant", F.col("p_value") < alpha)


# ---------------------------------------------------------------- L selection
def select_correlation(long: DataFrame, cols: list[str], threshold: float = 0.9) -> DataFrame:
    """L1: column j is dropped when any earlier column i (dropped or not) has |r| > t; NaN never drops."""
    order = F.create_map(*[v for i, x in enumerate(cols) for v in (F.lit(x), F.lit(i))])
    hit = long.where(F.abs("r") > threshold).select(
        F.when(order[F.col("a")] > order[F.col("b")], F.col("a")).otherwise(F.col("b")).alias("feature")).distinct()
    base = long.sparkSession.createDataFrame([(x, i) for i, x in enumerate(cols)], "feature string, position int")
    return base.join(hit.withColumn("_d", F.lit(True)), "feature", "left").select(
        "feature", "position", F.col("_d").isNull().alias("kept"))


def variances(df: DataFrame, cols: list[str]) -> DataFrame:
    wide = df.agg(*[F.var_samp(c(x).cast("double")).alias(f"v{i}") for i, x in enumerate(cols)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"v{i}").alias("variance"))
                                         for i, x in enumerate(cols)])))


def select_variance(df: DataFrame, cols: list[str], threshold: float = 0.01) -> DataFrame:
    """L2: keep sample variance > t."""
    return variances(df, cols).withColumn("kept", F.col("variance") > threshold)


def detect_constant(df: DataFrame, cols: list[str], threshold: float = 1e-6) -> DataFrame:
    """L3: sample variance <= t is constant."""
    return variances(df, cols).withColumn("constant", F.coalesce(F.col("variance") <= threshold, F.lit(True)))


def select_chi2(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """chi^2 of class sums of the shifted feature x - min + 1e-6 against class share x total."""
    mins = df.agg(*[F.min(c(x)).alias(x) for x in cols]).first().asDict()
    sums = [F.sum(c(x) - F.lit(mins[x]) + 1e-6).alias(f"s{i}") for i, x in enumerate(cols)]
    g = df.groupBy(c(target).alias("cls")).agg(F.count(F.lit(1)).alias("n_c"), *sums)
    long = g.select("cls", "n_c", F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"s{i}").alias("obs"))
                                                    for i, x in enumerate(cols)])))
    w = Window.partitionBy("feature")  # per feature: k class rows
    e = F.col("n_c") / F.sum("n_c").over(w) * F.sum("obs").over(w)
    long = long.withColumn("exp", e)
    return long.groupBy("feature").agg(F.sum((F.col("obs") - F.col("exp")) ** 2 / F.col("exp")).alias("chi2"))


def select_mutual_info(df: DataFrame, cols: list[str], target: str, bins: int = 10, method: str = "exact") -> DataFrame:
    """Plug-in mutual information (nats) of quantile-binned features with the target."""
    probs = [i / bins for i in range(1, bins)]
    cuts = fit_quantiles(df, cols, probs, method)
    out = None
    for x in cols:
        arr = F.array(*[F.lit(v) for v in cuts[x]])
        b = F.size(F.filter(arr, lambda q: q < c(x)))
        g = df.where(c(x).isNotNull()).groupBy(b.alias("bin"), c(target).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
        n = F.sum("n").over(Window.partitionBy())  # bins x classes rows
        pb = F.sum("n").over(Window.partitionBy("bin"))
        pc = F.sum("n").over(Window.partitionBy("cls"))
        term = F.col("n") / n * F.log(F.col("n") * n / (pb * pc))
        one = g.select(term.alias("t")).agg(F.lit(x).alias("feature"), F.sum("t").alias("mutual_info"))
        out = one if out is None else out.unionByName(one)
    return out


# psi(1) .. psi(9), the digamma function of small whole numbers.
DIGAMMA = [-0.5772156649015329, 0.42278433509846714, 0.9227843350984671, 1.2561176684318005, 1.5061176684318005,
           1.7061176684318005, 1.872784335098467, 2.01564147795561, 2.14064147795561]


def digamma(n: Column) -> Column:
    """psi of a whole number: a table up to 9, the asymptotic series beyond (error under 1e-11)."""
    x = n.cast("double")
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6) + 1 / (240 * x**8)
    return F.when(n < 10, F.element_at(F.array(*[F.lit(v) for v in DIGAMMA]), F.greatest(n, F.lit(1)).cast("int"))).otherwise(series)


def neighbour_mutual_info(df: DataFrame, cols: list[str], target: str, k: int = 3, block: int = 4096) -> DataFrame:
    """Nearest-neighbour mutual information (nats) of numbers with classes.

    For each row, r is the distance to the k-th nearest other row of its class
    (of a class of fewer rows: to its last), and m the number of all rows nearer
    than r, itself included.  Where r is 0, ties decide: k is the number of rows of
    the class at the value and m that of all rows there.  The result is psi(N) +
    mean psi(k) - mean psi(class size) - mean psi(m), 0 at least.  Classes of one
    row are left out, and so are rows with a null or NaN.

    Rows count by distinct (value, class).  These get exact positions on the
    class's line and lie in blocks of ``block`` positions with a halo of k on each
    side, so no window holds more than ``block + 2 k`` rows.  The counts inside r
    are differences of distributed running counts."""
    rows = df.select(c(target).alias("cls"), F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), c(x).cast("double").alias("x")) for x in cols])))
    rows = rows.where(F.col("cls").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x"))
    cells = rows.groupBy("feature", "cls", F.col("x") + F.lit(0.0)).agg(F.count(F.lit(1)).alias("n")).toDF("feature", "cls", "x", "n")
    sizes = cells.groupBy("feature", "cls").agg(F.sum("n").alias("size")).where("size > 1")
    cells = keep(cells.join(sizes, ["feature", "cls"]))

    placed = grouped_prefix(cells.withColumn("_one", F.lit(1)), ["feature", "cls"], ["x"], ["_one"]).withColumnRenamed("_one_before", "pos")
    block = max(block, 2 * k)
    home = F.floor(F.col("pos") / block).cast("long")
    near = F.sequence(F.greatest(F.floor((F.col("pos") - k) / block), F.lit(0)).cast("long"), F.floor((F.col("pos") + k) / block).cast("long"))
    spread = placed.select("feature", "cls", "x", "n", "size", "pos", home.alias("home"), F.explode(near).alias("block"))
    around = Window.partitionBy("feature", "cls", "block").orderBy("x").rowsBetween(-k, k)
    spread = spread.withColumn("around", F.collect_list(F.struct("x", "n")).over(around)).where("home = block")
    apart = F.sort_array(F.transform("around", lambda a: F.struct(F.abs(a["x"] - F.col("x")).alias("d"), a["n"].alias("n"))))
    want = F.least(F.lit(k).cast("long"), F.col("size") - 1)  # besides the row itself
    start = F.struct(F.lit(-1).cast("long").alias("seen"), F.lit(0.0).alias("r"))
    step = lambda s, a: F.struct((s["seen"] + a["n"]).alias("seen"), F.when(s["seen"] < want, a["d"]).otherwise(s["r"]).alias("r"))
    radius = spread.select("feature", "cls", "x", "n", "size", F.aggregate(apart, start, step)["r"].alias("r"), want.alias("k"))
    radius = radius.withColumn("k", F.when(F.col("r") == 0, F.col("n")).otherwise(F.col("k")))

    # the counts: data rows between the questions "rows below v" (before equal values) and "rows up to v" (after them)
    data = cells.groupBy("feature", F.col("x").alias("v")).agg(F.sum("n").alias("n")).withColumn("side", F.lit(0))
    still = F.col("r") == 0
    ask = radius.select("*", F.inline(F.array(
        F.struct(F.when(still, F.col("x")).otherwise(F.col("x") + F.col("r")).alias("v"), F.when(still, 1).otherwise(-1).alias("side"), F.lit(1).alias("sign")),
        F.struct(F.when(still, F.col("x")).otherwise(F.col("x") - F.col("r")).alias("v"), F.when(still, -1).otherwise(1).alias("side"), F.lit(-1).alias("sign")))))
    ask = ask.select("feature", "cls", "x", F.col("n").alias("w"), "size", "k", "v", "side", "sign", F.lit(0).cast("long").alias("n"))
    both = ask.unionByName(data, allowMissingColumns=True)
    counted = grouped_prefix(both, ["feature"], ["v", "side"], ["n"]).where("sign is not null")
    inside = counted.groupBy("feature", "cls", "x", "w", "size", "k").agg(F.sum(F.col("sign") * F.col("n_before")).alias("m"))
    total = F.sum("w")
    mean = lambda e: F.sum(F.col("w") * digamma(e)) / total
    value = digamma(total) + mean(F.col("k")) - mean(F.col("size")) - mean(F.col("m"))
    found = inside.groupBy("feature").agg(F.greatest(value, F.lit(0.0)).alias("mutual_info"))
    names = df.sparkSession.createDataFrame([(x,) for x in cols], "feature string")
    return names.join(found, "feature", "left")


def target_size(n_rows: int, n_features: int) -> int:
    """max(5, min(floor(sqrt n), n div 10, p div 2))."""
    return max(5, min(int(math.isqrt(n_rows)), n_rows // 10, n_features // 2))


# Naming patterns of the feature categories, first match wins.
CATEGORY_PATTERNS = [
    ("temperature", ["temp", "temperature"]),
    ("mechanical", ["speed", "rpm", "torque", "rotational"]),
    ("wear", ["wear", "tool"]),
    ("power", ["power", "mechanical_power", "energy"]),
    ("operational", ["stress", "efficiency", "operational"]),
    ("interaction", ["interaction", "_x_", "ratio", "product"]),
    ("statistical", ["squared", "cubed", "log", "sqrt", "zscore"]),
    ("encoded", ["type_", "_low", "_medium", "_high"]),
]


def categorize(name: Column) -> Column:
    """Category of a feature name (lower-cased substring rules)."""
    low = F.lower(name)
    e = None
    for cat, words in CATEGORY_PATTERNS:
        cond = F.lit(False)
        for w in words:
            cond = cond | F.instr(low, w).cast("boolean")
        e = F.when(cond, cat) if e is None else e.when(cond, cat)
    return e.otherwise("other")


def gaussian_nb_fit(df: DataFrame, cols: list[str], target: str, smoothing: float = 1e-9) -> DataFrame:
    """G9 fit: per class prior, means and population variances (+ smoothing x largest variance)."""
    aggs = [F.count(F.lit(1)).alias("n_c")]
    for i, x in enumerate(cols):
        aggs += [F.avg(c(x)).alias(f"m{i}"), F.var_pop(c(x)).alias(f"v{i}")]
    g = df.groupBy(c(target).alias("cls")).agg(*aggs)
    eps = smoothing * max((df.agg(F.var_pop(c(x))).first()[0] or 0.0) for x in cols)
    return g.withColumns({f"v{i}": F.col(f"v{i}") + F.lit(eps) for i in range(len(cols))}).withColumn(
        "prior", F.col("n_c") / F.sum("n_c").over(Window.partitionBy()))


def gaussian_nb_predict(df: DataFrame, params: DataFrame, cols: list[str], key: str) -> DataFrame:
    """G9 predict: joint log-likelihood per class from the k fitted rows (literals,
    no join), prediction = arg max (smallest class on ties)."""
    rows = sorted(params.collect(), key=lambda r: r["cls"])
    lls = []
    for r in rows:
        ll = F.lit(math.log(r["prior"]))
        for i, x in enumerate(cols):
            m, v = r[f"m{i}"], r[f"v{i}"]
            ll = ll - 0.5 * math.log(2 * math.pi * v) - (c(x) - F.lit(m)) ** 2 / F.lit(2 * v)
        lls.append(F.struct(ll.alias("ll"), F.lit(-r["cls"]).alias("neg_cls")))
    best = F.greatest(*lls) if len(lls) > 1 else lls[0]
    return df.select(key, (-best["neg_cls"]).alias("prediction"), best["ll"].alias("max_ll"))


# ---------------------------------------------------------------- L20
def prepare_for_model(df: DataFrame, cols: list[str], kind: str, keep: list[str]) -> DataFrame:
    """Linear: C4 removals at 0.9, then robust scaling; neural: constant
    columns removed, then robust scaling; tree, ensemble and any other kind: numeric columns as they are."""
    from vigil.operators import prep as PR

    if kind == "linear":
        drop = {r["drop"] for r in corr_pairs(df, cols, 0.9).select("drop").collect()}
    elif kind == "neural":
        drop = {r["feature"] for r in detect_constant(df, cols).where("constant").collect()}
    else:
        return df.select(*[c(k) for k in keep], *[c(x).cast("double").alias(x) for x in cols])
    left = [x for x in cols if x not in drop]
    return PR.apply_scaler(df.select(*[c(k) for k in keep], *[c(x) for x in left]), PR.fit_scaler(df, left, "robust"))
