"""Profiling and aggregations.

Design rule: one pass per operator.  Every per-column statistic is one
expression in a single wide ``agg``; the one-row result is unpivoted with
``inline(array(struct...))`` into one row per column.  Per-value results
(value counts, histograms, crosstabs) are ``groupBy`` with map-side partial
aggregation.  Totals needed for shares are scalars from a one-row aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vigil.functions.numeric import round_rint
from vigil.functions.ordering import null_safe_join

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def c(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def boolean_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def quantiles(x: Column, probs: list[float], method: str = "exact", accuracy: int = 10000) -> Column:
    """Linear-interpolated quantiles (pandas / DuckDB rule) or the sketch form.

    ``exact`` keeps one counter per distinct value in the final merge; use
    ``approx`` for high-cardinality columns at scale (rank error 1/accuracy).
    """
    if method == "exact":
        return F.percentile(x, probs)
    if method == "approx":
        return F.percentile_approx(x, probs, accuracy)
    raise ValueError(f"unknown quantile method {method!r}")


def unpivot_structs(wide: DataFrame, rows: list[Column]) -> DataFrame:
    """One-row frame -> one row per struct in ``rows``."""
    return wide.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- A1 describe
def describe(df: DataFrame, cols: list[str] | None = None, method: str = "auto") -> DataFrame:
    """count, mean, sample std, min, quartiles (linear), max per numeric column.

    ``exact`` / ``approx``: everything in one aggregate.  ``auto``: moments in
    one aggregate, quartiles from ``fit_quantiles`` (bounded single pass or the
    distributed exact selection for high-cardinality columns)."""
    from vigil.functions.ordering import fit_quantiles

    cols = cols or numeric_columns(df)
    qs = fit_quantiles(df, cols, [0.25, 0.5, 0.75]) if method == "auto" else None
    aggs = []
    for i, x in enumerate(cols):
        v = c(x).cast("double")
        q = (F.array(*[F.lit(t).cast("double") for t in qs[x]]) if qs is not None
             else quantiles(v, [0.25, 0.5, 0.75], method))
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), q.alias(f"q{i}"), F.max(v).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(x).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                     F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"q{i}")[0].alias("q25"),
                     F.col(f"q{i}")[1].alias("q50"), F.col(f"q{i}")[2].alias("q75"), F.col(f"hi{i}").alias("max"))
            for i, x in enumerate(cols)]
    return unpivot_structs(wide, rows)


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, unique, top (most frequent; smallest on ties), freq per string column.

    Per column one grouped count (partial aggregation), then one aggregate
    over the value counts: ``min_by(value, (-n, value))`` is the top value.
    """
    cols = cols or string_columns(df)
    out = None
    for x in cols:
        vc = df.groupBy(c(x).alias("value")).agg(F.count(F.lit(1)).alias("n")).where(F.col("value").isNotNull())
        one = vc.agg(F.lit(x).alias("column"), F.sum("n").cast("long").alias("count"),
                     F.count(F.lit(1)).alias("unique"),
                     F.min_by("value", F.struct(F.negative(F.col("n")), F.col("value"))).alias("top"),
                     F.max("n").alias("freq"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- A2 value counts
def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    g = df.groupBy(c(col).alias(col)).agg(F.count(F.lit(1)).alias("count"))
    if dropna:
        g = g.where(c(col).isNotNull())
    total = g.agg(F.sum("count")).first()[0] or 0
    return g.withColumn("share", F.try_divide(F.col("count").cast("double"), F.lit(float(total))))


# ---------------------------------------------------------------- A3 group stats
def group_stats(df: DataFrame, by: str, cols: list[str], nd: int | None = 3) -> DataFrame:
    aggs = []
    for x in cols:
        m, s = F.avg(c(x)), F.stddev_samp(c(x))
        aggs += [(round_rint(m, nd) if nd is not None else m).alias(f"{x}_mean"),
                 (round_rint(s, nd) if nd is not None else s).alias(f"{x}_std")]
    return df.groupBy(c(by).alias(by)).agg(*aggs)


# ---------------------------------------------------------------- A4 crosstab
def crosstab(df: DataFrame, a: str, b: str, margins: bool = True, label: str = "All") -> DataFrame:
    """Long contingency table; with margins the row / column / grand totals
    come from ``cube`` in the same aggregation."""
    if not margins:
        return df.groupBy(c(a).cast("string").alias(a), c(b).cast("string").alias(b)).agg(
            F.count(F.lit(1)).alias("count"))
    d = df.select(c(a).cast("string").alias(a), c(b).cast("string").alias(b))
    g = d.cube(a, b).agg(F.count(F.lit(1)).alias("count"), F.grouping(a).alias("ga"), F.grouping(b).alias("gb"))
    return g.select(F.when(F.col("ga") == 1, label).otherwise(c(a)).alias(a),
                    F.when(F.col("gb") == 1, label).otherwise(c(b)).alias(b), "count")


# ---------------------------------------------------------------- A5 rate by type
def rate_by_group(df: DataFrame, by: str, target: str) -> DataFrame:
    g = df.groupBy(c(by).alias(by)).agg(F.count(F.lit(1)).alias("count"),
                                        F.count_if(c(target) == 1).alias("failures"))
    total = g.agg(F.sum("count")).first()[0] or 0
    return g.select(by, "count", F.try_divide(F.col("count") * 100.0, F.lit(float(total))).alias("share_pct"),
                    "failures", (F.col("count") - F.col("failures")).alias("non_failures"),
                    F.try_divide(F.col("failures") * 100.0, F.col("count")).alias("failure_pct"))


# ---------------------------------------------------------------- A6 nunique
def nunique(df: DataFrame, cols: list[str] | None = None, method: str = "exact", rsd: float = 0.01) -> DataFrame:
    cols = cols or df.columns
    if method == "exact":
        aggs = [F.count_distinct(c(x)).alias(f"d{i}") for i, x in enumerate(cols)]
    else:
        aggs = [F.approx_count_distinct(c(x), rsd).alias(f"d{i}") for i, x in enumerate(cols)]
    wide = df.agg(*aggs)
    return unpivot_structs(wide, [F.struct(F.lit(x).alias("column"), F.col(f"d{i}").alias("nunique"))
                                  for i, x in enumerate(cols)])


# ---------------------------------------------------------------- A7 / A12 nulls
def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: dtype, nulls, null %, distinct (one pass)."""
    cols = cols or df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, x in enumerate(cols):
        aggs += [F.count_if(c(x).isNull()).alias(f"z{i}"), F.count_distinct(c(x)).alias(f"d{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(x).alias("column"), F.lit(types[x]).alias("dtype"), F.col(f"z{i}").alias("nulls"),
                     F.try_divide(F.col(f"z{i}") * 100.0, F.col("_n")).alias("null_pct"),
                     F.col(f"d{i}").alias("distinct")) for i, x in enumerate(cols)]
    return unpivot_structs(wide, rows)


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A10: rows beyond the first of each identical group (map-side combined groupBy)."""
    cols = cols or df.columns
    g = df.groupBy(*[c(x) for x in cols]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"))


def missing_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A12 totals: cells, null cells, rows with any null, complete rows."""
    cols = cols or df.columns
    any_null = F.lit(False)
    n_null = F.lit(0)
    for x in cols:
        any_null = any_null | c(x).isNull()
        n_null = n_null + c(x).isNull().cast("int")
    return df.agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) * len(cols)).alias("cells"),
                  F.sum(n_null).cast("long").alias("null_cells"), F.count_if(any_null).alias("rows_with_nulls"),
                  F.count_if(~any_null).alias("complete_rows"))


def completeness(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.9) -> DataFrame:
    """Non-null share of cells, duplicate share, overall verdict."""
    cols = cols or df.columns
    ms = missing_summary(df, cols)
    dups = duplicate_count(df, cols).first()["duplicates"]
    j = ms.withColumn("duplicates", F.lit(dups).cast("long"))
    comp = 1 - F.try_divide(F.col("null_cells").cast("double"), F.col("cells").cast("double"))
    uniq = 1 - F.try_divide(F.col("duplicates").cast("double"), F.col("rows").cast("double"))
    return j.select((comp * 100).alias("completeness_pct"), comp.alias("completeness"), uniq.alias("uniqueness"),
                    F.when(comp > threshold, "Good").otherwise("Fair").alias("overall_quality"))


def missing_cooccurrence(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of 0/1 null flags for each column pair (i < j)."""
    aggs = []
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    for k, (a, b) in enumerate(pairs):
        aggs.append(F.corr(c(a).isNull().cast("double"), c(b).isNull().cast("double")).alias(f"r{k}"))
    wide = df.agg(*aggs)
    return unpivot_structs(wide, [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                                           F.col(f"r{k}").alias("null_corr")) for k, (a, b) in enumerate(pairs)])


def null_patterns(df: DataFrame, cols: list[str]) -> DataFrame:
    pat = F.concat_ws("", *[c(x).isNull().cast("int").cast("string") for x in cols])
    return df.groupBy(pat.alias("pattern")).agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- A14 / A15 classes
def class_balance(df: DataFrame, target: str) -> DataFrame:
    g = df.groupBy(c(target).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    b = g.agg(F.max("n").alias("majority"), F.min("n").alias("minority"), F.sum("n").alias("total"),
              F.count(F.lit(1)).alias("classes"))
    ratio = F.try_divide(F.col("majority").cast("double"), F.col("minority").cast("double"))
    share = F.try_divide(F.col("minority") * 100.0, F.col("total"))
    inv = F.try_divide(F.col("minority").cast("double"), F.col("majority").cast("double"))
    return b.select("classes", "majority", "minority", ratio.alias("imbalance_ratio"), share.alias("minority_pct"),
                    inv.alias("balance_ratio"),
                    F.when(inv < 0.1, "severe").when(inv < 0.3, "moderate").otherwise("balanced").alias("severity"),
                    ((ratio > 3) | (share < 10)).alias("warn"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """N / (k n_c), one row per class (small result)."""
    g = df.groupBy(c(target).alias(target)).agg(F.count(F.lit(1)).alias("n_c"))
    tot = g.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return g.withColumn("weight", F.try_divide(F.lit(float(tot["n"] or 0)), F.col("n_c") * int(tot["k"] or 0)))


# ---------------------------------------------------------------- A16-A19 failure modes
def mode_counts(df: DataFrame, modes: list[str], target: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(c(target) == 1).alias("_f")]
    for i, m in enumerate(modes):
        aggs += [F.sum(c(m)).cast("long").alias(f"s{i}"), F.count_if((c(m) == 1) & (c(target) == 1)).alias(f"t{i}")]
    wide = df.agg(*aggs)
    return unpivot_structs(wide, [F.struct(F.lit(m).alias("mode"), F.col(f"s{i}").alias("count"),
                                           F.try_divide(F.col(f"s{i}") * 100.0, F.col("_n")).alias("pct"),
                                           F.col(f"t{i}").alias("with_failure"))
                                  for i, m in enumerate(modes)])


def simultaneous_modes(df: DataFrame, modes: list[str]) -> DataFrame:
    k = sum((c(m) for m in modes[1:]), c(modes[0]))
    return df.groupBy(k.alias("modes_set")).agg(F.count(F.lit(1)).alias("count"))


def target_or_check(df: DataFrame, modes: list[str], target: str) -> DataFrame:
    any_mode = F.greatest(*[c(m) for m in modes])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(c(target) != any_mode).alias("mismatches"),
                  F.bool_and(c(target) == any_mode).alias("target_is_or"),
                  F.count_if((c(target) == 1) & (any_mode == 0)).alias("failure_without_mode"),
                  F.count_if((c(target) == 0) & (any_mode == 1)).alias("mode_without_failure"))


def mode_label(modes: list[str], names: list[str] | None = None) -> Column:
    names = names or [m.upper() for m in modes]
    lab = F.concat_ws("+", *[F.when(c(m) == 1, F.lit(n)) for m, n in zip(modes, names)])
    return F.when(lab == "", "No Failure").otherwise(lab)


def mode_combinations(df: DataFrame, modes: list[str], top: int = 10) -> DataFrame:
    g = df.groupBy(mode_label(modes).alias("combination")).agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.desc("count"), F.asc("combination")).limit(top)


# ---------------------------------------------------------------- A20-A22 binning
def fit_range(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.min(c(col)).cast("double"), F.max(c(col)).cast("double")).first()
    return r[0], r[1]


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1 (the top edge goes to the last bin)."""
    w = (hi - lo) / bins if hi is not None and lo is not None and hi > lo else 1.0
    return F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None, density: bool = False) -> DataFrame:
    lo, hi = fit_range(df, col)
    w = (hi - lo) / bins if lo is not None and hi > lo else 1.0
    keys = ([c(by).alias(by)] if by else []) + [bin_index(c(col), lo, hi, bins).alias("bin")]
    g = df.where(c(col).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    g = g.withColumns({"bin_lo": F.lit(lo) + F.col("bin") * F.lit(w), "bin_hi": F.lit(lo) + (F.col("bin") + 1) * F.lit(w)})
    if density:
        tot = Window.partitionBy(by) if by else Window.partitionBy()
        g = g.withColumn("density", F.col("count") / (F.sum("count").over(tot) * F.lit(w)))
    return g


def binned_target(df: DataFrame, col: str, target: str, bins: int = 10) -> DataFrame:
    """Pd.cut(x, bins) right-closed bins, lowest edge widened by 0.1 % of the range, x class counts."""
    lo, hi = fit_range(df, col)
    w = (hi - lo) / bins
    b = F.greatest(F.ceil((c(col) - F.lit(lo)) / F.lit(w)) - 1, F.lit(0)).cast("int")
    b = F.least(b, F.lit(bins - 1))
    g = df.groupBy(b.alias("bin")).pivot(target, [0, 1]).agg(F.count(F.lit(1)))
    return g.select("bin", F.coalesce(F.col("0"), F.lit(0)).cast("long").alias("n0"),
                    F.coalesce(F.col("1"), F.lit(0)).cast("long").alias("n1"))


def boxplot_stats(df: DataFrame, col: str, by: str, k: float = 1.5, method: str = "auto") -> DataFrame:
    """Per group quartiles, whisker ends (extreme points inside the fences), outlier count.

    Pass 1: exact grouped quartiles (``auto``: distributed selection, no group's
    values held in one task; or ``exact`` / ``approx`` grouped aggregates).
    Pass 2 joins the per-group table back (nulls are a group) and uses
    conditional min / max.
    """
    if method == "auto":
        from vigil.functions.ordering import exact_quantiles_distributed

        long = exact_quantiles_distributed(df.select(c(by).alias(by), c(col).alias("_x")), "_x", [0.25, 0.5, 0.75], [by])
        q = long.groupBy(by).pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value"))
        q = q.select(by, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q3"))
    else:
        q = df.groupBy(c(by).alias(by)).agg(quantiles(c(col), [0.25, 0.5, 0.75], method).alias("q"))
        q = q.select(by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumns({"lo_fence": F.col("q1") - k * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + k * (F.col("q3") - F.col("q1"))})
    j = null_safe_join(df.select(c(by).alias(by), c(col).alias("_x")), q, [by])
    inside = (F.col("_x") >= F.col("lo_fence")) & (F.col("_x") <= F.col("hi_fence"))
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"), F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"))


# ---------------------------------------------------------------- A23 overview
def frame_overview(df: DataFrame) -> DataFrame:
    num, st, bo = numeric_columns(df), string_columns(df), boolean_columns(df)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), F.lit(len(num)).alias("numeric_columns"),
        F.lit(len(st)).alias("string_columns"), F.lit(len(bo)).alias("boolean_columns"),
        F.lit(len(df.columns) - len(num) - len(st) - len(bo)).alias("other_columns"))


# ---------------------------------------------------------------- A9 moments
def bias_corrected_moments(n: Column, g1: Column, g2: Column) -> tuple[Column, Column]:
    """Sample skewness G1 and excess kurtosis G2 from Spark's population forms."""
    skew = F.when(n >= 3, F.sqrt(n * (n - 1)) / (n - 2) * g1)
    kurt = F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return skew, kurt


def feature_metadata(df: DataFrame, cols: list[str], categorize=None) -> DataFrame:
    aggs = []
    for i, x in enumerate(cols):
        v = c(x).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(v.isNull()).alias(f"z{i}"), F.count_distinct(v).alias(f"d{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.avg(v).alias(f"m{i}"),
                 F.stddev_samp(v).alias(f"s{i}"), F.var_samp(v).alias(f"v{i}"), F.skewness(v).alias(f"g{i}"),
                 F.kurtosis(v).alias(f"k{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, x in enumerate(cols):
        n = F.col(f"n{i}").cast("double")
        sk, ku = bias_corrected_moments(n, F.col(f"g{i}"), F.col(f"k{i}"))
        cat = categorize(x) if categorize else F.lit(None).cast("string")
        rows.append(F.struct(F.lit(x).alias("feature"), cat.alias("category"),
                             F.lit(dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)[x]).alias("dtype"),
                             F.col(f"z{i}").alias("nulls"), F.col(f"d{i}").alias("distinct"),
                             F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"), F.col(f"m{i}").alias("mean"),
                             F.col(f"s{i}").alias("std"), F.col(f"v{i}").alias("var"), sk.alias("skew"),
                             ku.alias("kurtosis")))
    return unpivot_structs(wide, rows)


def feature_quality(df: DataFrame, cols: list[str], missing_threshold: float = 0.05) -> DataFrame:
    """Per-feature issues (missing share > t, constant, infinities, cardinality > 0.9 n) and
    the overall score 1 - features_with_issues / features (same on every row)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, x in enumerate(cols):
        v = c(x)
        aggs += [F.count_if(v.isNull()).alias(f"z{i}"), F.count_distinct(v).alias(f"d{i}"),
                 F.count_if(F.abs(v.cast("double")) == float("inf")).alias(f"i{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, x in enumerate(cols):
        miss = F.try_divide(F.col(f"z{i}").cast("double"), F.col("_n").cast("double"))
        rows.append(F.struct(F.lit(x).alias("feature"), F.col(f"z{i}").alias("nulls"), miss.alias("missing_share"),
                             F.col(f"d{i}").alias("distinct"), (F.col(f"d{i}") <= 1).alias("constant"),
                             F.col(f"i{i}").alias("infinite"),
                             (F.col(f"d{i}") > F.col("_n") * 0.9).alias("high_cardinality"),
                             (miss > missing_threshold).alias("high_missing")))
    long = unpivot_structs(wide, rows)
    issue = (F.col("constant") | (F.col("infinite") > 0) | F.col("high_cardinality") | F.col("high_missing"))
    long = long.withColumn("has_issue", issue)
    k = len(cols)
    # the long result has one row per feature (schema-sized), so a global window is bounded
    return long.withColumn("quality_score", 1 - F.count_if(F.col("has_issue")).over(Window.partitionBy()) / F.lit(k))
