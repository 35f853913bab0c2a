"""Statistics and closed-form selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import features as FX
from vigil.operators import prep as PR
from vigil.operators import linear as LN
from vigil.operators import stats as ST
from vigil.plans import sql_features as SF
from vigil.plans.catalog import query, rnd, round_doubles, rsig_sql
from vigil.functions.numeric import round_sig
from vigil.sources import fixtures as X

SENS = ["air_temp", "proc_temp", "speed", "torque", "wear"]
_H = PR.split_hash_sql()


def S(body: str, extra: str = "") -> str:
    return X.with_sql(X.SENSOR_SQL + extra, body)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


# Engineered view used by the correlation-based selections.
_ENG = {"torque": "torque", "wear": "wear", "speed": "speed", "mechanical_power": SF.MP,
        "wear_squared": "wear*wear", "wear_torque_interaction": "wear*torque/100",
        "specific_power": SF.POWER["specific_power"]}
_ENG_CTE = ",\neng AS (SELECT key, failure, " + ", ".join(f"{v} AS {k}" for k, v in _ENG.items()) + " FROM sensor)"


def eng_frame(spark, sf):
    s = X.sensor(spark, sf)
    p = FX.power_cols()
    w = FX.wear_cols()
    return s.select("key", "failure", "torque", "wear", "speed", p["mechanical_power"].alias("mechanical_power"),
                    w["wear_squared"].alias("wear_squared"), w["wear_torque_interaction"].alias("wear_torque_interaction"),
                    p["specific_power"].alias("specific_power"))


_ENG_COLS = list(_ENG)

# ---------------------------------------------------------------- C1-C7
_C1 = SENS + ["failure"]


@query("corr_pearson", S(_union(
    [f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM sensor" for a, b in _pairs(_C1)] +
    [f"SELECT '{b}' AS a, '{a}' AS b, round(corr({a}, {b}), 6) AS r FROM sensor" for a, b in _pairs(_C1)] +
    [f"SELECT '{a}' AS a, '{a}' AS b, 1.0::DOUBLE AS r" for a in _C1])))
def q_corr_pearson(spark, sf):
    """Full Pearson matrix (long form) of the sensors and the target, one aggregate."""
    s = X.sensor(spark, sf)
    return round_doubles(ST.corr_long(s, _C1, full=True))


def _avg_rank_sql(x):
    return f"(rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1)/2.0)"


@query("corr_spearman", S(_union([f"SELECT '{a}' AS a, '{b}' AS b, round(corr(ra_{a}, ra_{b}), 6) AS r FROM rk"
                                  for a, b in _pairs(SENS)]),
                          ",\nrk AS (SELECT " + ", ".join(f"{_avg_rank_sql(x)} AS ra_{x}" for x in SENS) + " FROM sensor)"))
def q_corr_spearman(spark, sf):
    """Spearman = Pearson on average ranks (ranks per distinct value, prefix sums, joined back)."""
    return round_doubles(ST.corr_spearman(X.sensor(spark, sf), SENS))


@query("corr_kendall", S("""SELECT 'torque' AS x, 'wear' AS y,
  round((SELECT sum(CASE WHEN (a.x - b.x)*(a.y - b.y) > 0 THEN a.n*b.n WHEN (a.x - b.x)*(a.y - b.y) < 0 THEN -a.n*b.n
                         ELSE 0 END)/2 FROM cells a, cells b)
        / sqrt((nn*(nn - 1)/2 - (SELECT sum(t*(t - 1)/2) FROM (SELECT sum(n) AS t FROM cells GROUP BY x)))
             * (nn*(nn - 1)/2 - (SELECT sum(t*(t - 1)/2) FROM (SELECT sum(n) AS t FROM cells GROUP BY y)))), 6) AS tau_b
  FROM (SELECT CAST(sum(n) AS DOUBLE) AS nn FROM cells)""",
    ",\ncells AS (SELECT torque AS x, wear AS y, CAST(count(*) AS DOUBLE) AS n FROM sensor GROUP BY ALL)"))
def q_corr_kendall(spark, sf):
    """Kendall tau-b of torque and wear from their contingency table (exact: few distinct values)."""
    tau = ST.kendall_tau_b(X.sensor(spark, sf), "torque", "wear")
    df = spark.createDataFrame([("torque", "wear", tau)], "x string, y string, tau_b double")
    return round_doubles(df)


def _var_sql(x):
    return f"(SELECT var_samp({x}) FROM eng)"


@query("corr_pairs", S("SELECT a, b, round(r, 6) AS r, CASE WHEN va >= vb THEN b ELSE a END AS \"drop\" FROM (" + _union(
    [f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, {_var_sql(a)} AS va, {_var_sql(b)} AS vb FROM eng"
     for a, b in _pairs(_ENG_COLS)]) + ") WHERE abs(r) > 0.7", _ENG_CTE))
def q_corr_pairs(spark, sf):
    """C4: engineered-feature pairs with |r| > 0.7 and the lower-variance member to drop."""
    return round_doubles(ST.corr_pairs(eng_frame(spark, sf), _ENG_COLS, 0.7))


@query("corr_target", S("""SELECT feature, round(r, 6) AS r, round(abs(r), 6) AS abs_r,
  CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS INTEGER) AS rank,
  CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.5 THEN 'moderate' WHEN abs(r) >= 0.3 THEN 'weak'
       ELSE 'very weak' END AS strength FROM (""" + _union(
    [f"SELECT '{x}' AS feature, corr({x}, failure) AS r FROM eng" for x in _ENG_COLS]) + ")", _ENG_CTE))
def q_corr_target(spark, sf):
    """|corr| with the target, ranked, with strength bands."""
    out = ST.corr_target(eng_frame(spark, sf), _ENG_COLS, "failure")
    return round_doubles(out.withColumn("rank", F.col("rank").cast("int")))


@query("corr_summary", S("""SELECT count(r) AS pairs, round(avg(abs(r)), 6) AS mean_abs, round(max(abs(r)), 6) AS max_abs,
  round(min(r), 6) AS min_r, round(max(r), 6) AS max_r, count(*) FILTER (WHERE abs(r) > 0.5) AS above_05,
  count(*) FILTER (WHERE abs(r) > 0.7) AS above_07 FROM (""" + _union(
    [f"SELECT corr({a}, {b}) AS r FROM eng" for a, b in _pairs(_ENG_COLS)]) + ")", _ENG_CTE))
def q_corr_summary(spark, sf):
    """Distribution of the upper-triangle correlations of the engineered features."""
    return round_doubles(ST.corr_summary(ST.corr_long(eng_frame(spark, sf), _ENG_COLS)))


@query("linear_trend", S("""SELECT feature, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r, 6) AS r
  FROM (""" + _union([f"""SELECT '{x}' AS feature, regr_slope(failure, {x}) AS slope,
    regr_intercept(failure, {x}) AS intercept, corr({x}, failure) AS r FROM eng""" for x in _ENG_COLS]) +
    ") ORDER BY abs(r) DESC NULLS LAST, feature LIMIT 1", _ENG_CTE))
def q_linear_trend(spark, sf):
    """Straight-line fit of the target on its best-correlated feature."""
    e = eng_frame(spark, sf)
    best = ST.corr_target(e, _ENG_COLS, "failure").where(F.col("rank") == 1).first()["feature"]
    return round_doubles(ST.linear_trend(e, best, "failure"))


# ---------------------------------------------------------------- C8
def _mom_sql(by):
    return _union([f"""SELECT '{x}' AS feature, {by} AS cls, count({x}) AS n, avg({x}) AS mean, var_samp({x}) AS var
  FROM sensor GROUP BY {by}""" for x in SENS])


@query("ttest_anova", S(f"""SELECT a.feature, round((a.mean - b.mean)/sqrt((((a.n - 1)*a.var + (b.n - 1)*b.var)/(a.n + b.n - 2))
    *(1.0/a.n + 1.0/b.n)), 6) AS t_stat, a.n + b.n - 2 AS dof
  FROM m a JOIN m b ON a.feature = b.feature AND a.cls = 0 AND b.cls = 1""", f",\nm AS ({_mom_sql('failure')})"))
def q_ttest_anova(spark, sf):
    """Pooled two-sample t per sensor, failure 0 vs 1 (moments from one grouped pass)."""
    t = ST.pooled_t(ST.group_moments(X.sensor(spark, sf), SENS, "failure"))
    return round_doubles(t.withColumn("dof", F.col("dof").cast("long")))


@query("anova_f", S("""SELECT feature, CAST(count(*) - 1 AS BIGINT) AS df1, CAST(sum(n) - count(*) AS BIGINT) AS df2,
  round(((sum(n*mean*mean) - sum(n*mean)*sum(n*mean)/sum(n))/(count(*) - 1))
        / (sum((n - 1)*coalesce(var, 0))/(sum(n) - count(*))), 6) AS f_stat
  FROM m GROUP BY feature""", f",\nm AS ({_mom_sql('type')})"))
def q_anova_f(spark, sf):
    """One-way ANOVA F per sensor across machine types."""
    f = ST.anova_f(ST.group_moments(X.sensor(spark, sf), SENS, "type"))
    return round_doubles(f.select("feature", F.col("df1").cast("long"), F.col("df2").cast("long"), "f_stat"))


@query("ttest_pvalues")
def q_ttest_pvalues(spark, sf):
    """C8 p-values: t (failure) and F (type) statistics with p from the incomplete beta, and stars."""
    s = X.sensor(spark, sf)
    t = ST.pooled_t(ST.group_moments(s, SENS, "failure"))
    t = t.select("feature", F.lit("t").alias("test"), F.col("t_stat").alias("statistic"),
                 ST.t_pvalue(F.col("t_stat"), F.col("dof").cast("double")).alias("p_value"))
    f = ST.anova_f(ST.group_moments(s, SENS, "type"))
    f = f.select("feature", F.lit("F").alias("test"), F.col("f_stat").alias("statistic"),
                 ST.f_pvalue(F.col("f_stat"), F.col("df1").cast("double"), F.col("df2").cast("double")).alias("p_value"))
    out = t.unionByName(f)
    return out.withColumn("stars", ST.stars(F.col("p_value")))


# ---------------------------------------------------------------- C9-C11
def _jb_sql(x):
    return f"""SELECT '{x}' AS feature, count({x}) AS n, round(sk, 6) AS skew, round(ku, 6) AS kurt,
  round(count({x})/6.0*(sk*sk + ku*ku/4), 6) AS jb, round(exp(-(count({x})/6.0*(sk*sk + ku*ku/4))/2), 6) AS p_value
  FROM sensor, (SELECT avg(power({x} - m, 3))/power(avg(power({x} - m, 2)), 1.5) AS sk,
                       avg(power({x} - m, 4))/power(avg(power({x} - m, 2)), 2) - 3 AS ku
                FROM sensor, (SELECT avg({x}) AS m FROM sensor)) GROUP BY sk, ku"""


@query("normality_jb", S(_union([_jb_sql(x) for x in SENS])))
def q_normality_jb(spark, sf):
    """Jarque-Bera from population moments per sensor."""
    out = None
    s = X.sensor(spark, sf)
    for x in SENS:
        one = ST.jarque_bera(s, x)
        out = one if out is None else out.unionByName(one)
    return round_doubles(out)


_QQ_P = [(i - 0.5) / 20 for i in range(1, 21)]


@query("qq_points", S(_union([
    f"SELECT {i + 1} AS i, round(CAST({p!r} AS DOUBLE), 6) AS prob, "
    f"round(CAST({ST.normal_quantile(p)!r} AS DOUBLE), 6) AS theoretical, "
    f"round(quantile_cont(torque, {p!r}), 6) AS sample FROM sensor" for i, p in enumerate(_QQ_P)])))
def q_qq_points(spark, sf):
    """20 torque quantiles against standard normal quantiles."""
    return round_doubles(ST.qq_points(X.sensor(spark, sf), "torque", 20))


def fold_scores(spark, sf):
    """Per (model, fold) accuracy of the stand-in scorers over stratified 5 folds."""
    sm = X.scored_many(spark, sf)
    folds = PR.kfold(X.sensor(spark, sf).select("key", "failure"), "failure", "key", 5).select("key", "fold")
    j = sm.join(folds, "key")
    return j.groupBy("model_name", "fold").agg(F.avg((F.col("y") == F.col("yhat")).cast("double")).alias("score"))


_FOLD_SQL = f""",
folds AS (SELECT key, CAST((row_number() OVER (PARTITION BY failure ORDER BY {_H}, key) - 1) % 5 AS INTEGER) AS fold
          FROM sensor),
fs AS (SELECT model_name, fold, avg(CAST(y = yhat AS DOUBLE)) AS score FROM scored_many JOIN folds USING (key)
       GROUP BY ALL)"""


@query("paired_ttest", X.with_sql(X.SCORED_MANY_SQL + _FOLD_SQL, """SELECT model_a, model_b, n, round(mean_diff, 6) AS mean_diff,
  round(sd_diff, 6) AS sd_diff, round(mean_diff/(sd_diff/sqrt(n)), 6) AS t_stat, n - 1 AS dof FROM (
  SELECT a.model_name AS model_a, b.model_name AS model_b, count(*) AS n, avg(a.score - b.score) AS mean_diff,
         stddev_samp(a.score - b.score) AS sd_diff
  FROM fs a JOIN fs b ON a.fold = b.fold AND a.model_name < b.model_name GROUP BY ALL)"""))
def q_paired_ttest(spark, sf):
    """C11: paired t on per-fold accuracies for every pair of scorers."""
    return round_doubles(ST.paired_ttest(fold_scores(spark, sf)))


@query("paired_ttest_verdict", X.with_sql(X.SCORED_MANY_SQL + _FOLD_SQL, """SELECT model_a, model_b, round(p, 6) AS p_value,
  CASE WHEN mean_diff > 0 THEN model_a WHEN mean_diff < 0 THEN model_b END AS better_model, p < 0.05 AS significant FROM (
  SELECT *, 1 - 2*(0.375*abs(t)/sqrt(1 + t*t/4)*(1 - t*t/(12*(1 + t*t/4)))) AS p FROM (  -- Student's t with 4 degrees, closed form
  SELECT model_a, model_b, mean_diff, mean_diff/(sd_diff/sqrt(n)) AS t FROM (
  SELECT a.model_name AS model_a, b.model_name AS model_b, count(*) AS n, avg(a.score - b.score) AS mean_diff,
         stddev_samp(a.score - b.score) AS sd_diff
  FROM fs a JOIN fs b ON a.fold = b.fold AND a.model_name < b.model_name GROUP BY ALL)))"""))
def q_paired_ttest_verdict(spark, sf):
    """C11: p-value, significance and better model of every pair of scorers (5 folds)."""
    out = ST.paired_verdict(ST.paired_ttest(fold_scores(spark, sf)))
    return round_doubles(out.select("model_a", "model_b", "p_value", "better_model", "significant"))


# ---------------------------------------------------------------- L1-L6
_L1_COLS = _ENG_COLS


def _l1_sql():
    pos = {x: i for i, x in enumerate(_L1_COLS)}
    hits = _union([f"SELECT '{b}' AS feature FROM eng HAVING abs(corr({a}, {b})) > 0.9" for a, b in _pairs(_L1_COLS)])
    base = _union([f"SELECT '{x}' AS feature, {i} AS position" for x, i in pos.items()])
    return S(f"""SELECT feature, position, feature NOT IN (SELECT feature FROM ({hits})) AS kept FROM ({base})""", _ENG_CTE)


@query("select_correlation", _l1_sql())
def q_select_correlation(spark, sf):
    """L1: drop a column when any earlier column has |r| > 0.9."""
    e = eng_frame(spark, sf)
    out = ST.select_correlation(ST.corr_long(e, _L1_COLS), _L1_COLS, 0.9)
    return out.withColumn("position", F.col("position").cast("int"))


_VAR_COLS = SENS + ["const"]


@query("select_variance", S(_union([f"SELECT '{x}' AS feature, round(var_samp({x}), 6) AS variance, var_samp({x}) > 0.01 AS kept "
                                    f"FROM (SELECT *, 1.0 AS const FROM sensor)" for x in _VAR_COLS])))
def q_select_variance(spark, sf):
    """L2: keep sample variance > 0.01 (the constant column goes)."""
    d = X.sensor(spark, sf).withColumn("const", F.lit(1.0))
    return round_doubles(ST.select_variance(d, _VAR_COLS, 0.01))


@query("detect_constant", S(_union([f"SELECT '{x}' AS feature, round(var_samp({x}), 6) AS variance, "
                                    f"coalesce(var_samp({x}) <= 1e-6, true) AS constant "
                                    f"FROM (SELECT *, 1.0 AS const FROM sensor)" for x in _VAR_COLS])))
def q_detect_constant(spark, sf):
    """L3: variance <= 1e-6 is constant."""
    d = X.sensor(spark, sf).withColumn("const", F.lit(1.0))
    return round_doubles(ST.detect_constant(d, _VAR_COLS))


@query("select_f_test", S("""SELECT feature, round(f_stat, 6) AS f_stat,
  CAST(row_number() OVER (ORDER BY f_stat DESC NULLS LAST, feature) AS INTEGER) AS rank FROM (
  SELECT feature, ((sum(n*mean*mean) - sum(n*mean)*sum(n*mean)/sum(n))/(count(*) - 1))
        / (sum((n - 1)*coalesce(var, 0))/(sum(n) - count(*))) AS f_stat FROM m GROUP BY feature)
  QUALIFY rank <= 3""", f",\nm AS ({_mom_sql('failure')})"))
def q_select_f_test(spark, sf):
    """L4: ANOVA F of each sensor against the target, top 3 (the cut is the feature)."""
    from pyspark.sql.window import Window

    f = ST.anova_f(ST.group_moments(X.sensor(spark, sf), SENS, "failure"))
    f = f.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("f_stat"), "feature")).cast("int"))
    return round_doubles(f.where(F.col("rank") <= 3).select("feature", "f_stat", "rank"))


@query("select_chi2", S("SELECT feature, " + rsig_sql("sum((obs - e)*(obs - e)/e)") + " AS chi2 FROM (SELECT feature, obs, "
                        "n_c*1.0/sum(n_c) OVER (PARTITION BY feature)*sum(obs) OVER (PARTITION BY feature) AS e FROM (" +
                        _union([f"""SELECT '{x}' AS feature, failure, count(*) AS n_c,
  sum({x} - (SELECT min({x}) FROM sensor) + 1e-6) AS obs FROM sensor GROUP BY failure""" for x in SENS]) +
                        ")) GROUP BY feature"))
def q_select_chi2(spark, sf):
    """Chi-square score of each shifted sensor's class sums."""
    out = ST.select_chi2(X.sensor(spark, sf), SENS, "failure")
    return out.select("feature", round_sig(F.col("chi2")).alias("chi2"))


def _mi_sql(x):
    probs = ", ".join(repr(i / 10) for i in range(1, 10))
    return f"""SELECT '{x}' AS feature, round(sum(n/nn*ln(n*nn/(pb*pc))), 6) AS mutual_info FROM (
  SELECT n, sum(n) OVER () AS nn, sum(n) OVER (PARTITION BY bin) AS pb, sum(n) OVER (PARTITION BY failure) AS pc FROM (
    SELECT len(list_filter(q, lambda c: c < {x})) AS bin, failure, CAST(count(*) AS DOUBLE) AS n
    FROM sensor, (SELECT quantile_cont({x}, [{probs}]) AS q FROM sensor) WHERE {x} IS NOT NULL GROUP BY ALL))"""


@query("select_mutual_info_bins", S(_union([_mi_sql(x) for x in SENS])))
def q_select_mutual_info_bins(spark, sf):
    """Plug-in mutual information of decile-binned sensors with the target."""
    return round_doubles(ST.select_mutual_info(X.sensor(spark, sf), SENS, "failure"))


def _psi_sql(n):
    x = f"CAST({n} AS DOUBLE)"
    p = lambda k: "*".join([x] * k)
    series = f"ln({x}) - 1/(2*{x}) - 1/(12*{p(2)}) + 1/(120*{p(4)}) - 1/(252*{p(6)}) + 1/(240*{p(8)})"
    return f"CASE WHEN {n} < 10 THEN [{', '.join(map(repr, ST.DIGAMMA))}][CAST(greatest({n}, 1) AS INTEGER)] ELSE {series} END"


_L6_SQL = S(f"""SELECT feature, round(greatest({_psi_sql('sum(w)')} + sum(w*({_psi_sql('k')}))/sum(w) - sum(w*({_psi_sql('size')}))/sum(w)
    - sum(w*({_psi_sql('m')}))/sum(w), 0.0), 6) AS mutual_info
  FROM (SELECT feature, cls, x, w, size, k, CAST(sum(sign*before) AS BIGINT) AS m FROM cum WHERE sign IS NOT NULL GROUP BY ALL) GROUP BY feature""", """,
long6 AS (""" + _union([f"SELECT '{x}' AS feature, failure AS cls, CAST({x} AS DOUBLE) AS x FROM sensor WHERE {x} IS NOT NULL" for x in SENS]) + """),
cells AS (SELECT *, CAST(sum(n) OVER (PARTITION BY feature, cls) AS BIGINT) AS size FROM (
  SELECT feature, cls, x, count(*) AS n FROM long6 GROUP BY ALL) QUALIFY size > 1),
around AS (SELECT feature, cls, x, n, size, least(3, size - 1) AS k,
  unnest(list({'x': x, 'n': n}) OVER (PARTITION BY feature, cls ORDER BY x ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) AS a FROM cells),
reach AS (SELECT feature, cls, x, n, size, k, abs(a.x - x) AS d,
  sum(a.n) OVER (PARTITION BY feature, cls, x ORDER BY abs(a.x - x)) AS upto FROM around),
radius AS (SELECT feature, cls, x, n, size, CASE WHEN min(d) FILTER (WHERE upto > k) = 0 THEN n ELSE k END AS k,
  min(d) FILTER (WHERE upto > k) AS r FROM reach GROUP BY feature, cls, x, n, size, reach.k),
ask AS (SELECT feature, cls, x, n AS w, size, k, CASE WHEN r = 0 THEN x ELSE x + r END AS v, CASE WHEN r = 0 THEN 1 ELSE -1 END AS side, 1 AS sign FROM radius
  UNION ALL SELECT feature, cls, x, n, size, k, CASE WHEN r = 0 THEN x ELSE x - r END, CASE WHEN r = 0 THEN -1 ELSE 1 END, -1 FROM radius),
both6 AS (SELECT feature, cls, x, w, size, k, v, side, sign, 0 AS n FROM ask
  UNION ALL SELECT feature, NULL, NULL, NULL, NULL, NULL, x, 0, NULL, sum(n) FROM cells GROUP BY feature, x),
cum AS (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY v, side) AS before FROM both6)""")


@query("select_mutual_info", _L6_SQL)
def q_select_mutual_info(spark, sf):
    """Nearest-neighbour mutual information (k = 3) of the sensors with the target."""
    return round_doubles(ST.neighbour_mutual_info(X.sensor(spark, sf), SENS, "failure"))


# ---------------------------------------------------------------- L15, L18-L20
@query("target_size", S("""SELECT count(*) AS n_rows, 57 AS n_features,
  greatest(5, least(CAST(floor(sqrt(count(*))) AS BIGINT), count(*) // 10, 57 // 2)) AS target_size FROM sensor"""))
def q_target_size(spark, sf):
    """Selection size from the row count and the extended set's width."""
    s = X.sensor(spark, sf)
    n = s.count()
    p = len(FX.feature_set(s, "extended").columns)
    return s.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(p).alias("n_features"), F.lit(ST.target_size(n, p)).cast("long").alias("target_size"))


_ALL_FEATS = {**{k: k for k in SENS}, **{k: v for fam in SF.FAMILIES.values() for k, v in fam.items()}}


def _cat_sql(name: str) -> str:
    parts = []
    for cat, words in ST.CATEGORY_PATTERNS:
        cond = " OR ".join(f"contains(lower('{name}'), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{cat}'")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


@query("categorize_features", S("SELECT * FROM (" + _union([
    f"SELECT '{k}' AS feature, {_cat_sql(k)} AS category, count({v}) AS non_null FROM sensor, op, st"
    for k, v in _ALL_FEATS.items()]) + ")", ",\n" + SF.OP_CTE + ",\n" + SF.ST_CTE))
def q_categorize_features(spark, sf):
    """Category of every baseline + engineered feature (first matching name rule)."""
    s = X.sensor(spark, sf)
    params = FX.fit_extended(s)
    cols = {k: F.col(k) for k in SENS}
    for fam in FX.FAMILIES:
        cols.update(FX.family_cols(fam, params))
    wide = s.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(cols.values())])
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(f"n{i}").alias("non_null"))
                                         for i, k in enumerate(cols)])))
    return long.select("feature", ST.categorize(F.col("feature")).alias("category"), "non_null")


def _set_cols(kind):
    with_base, fams = FX.FEATURE_SETS[kind]
    names = list(SENS) if with_base else []
    for f in fams:
        names += list(SF.FAMILIES[f])
    return names


_A, _B = _set_cols("temperature_focus"), _set_cols("wear_focus")


@query("compare_feature_sets", S(f"""SELECT feature, membership,
  round({len(set(_A) & set(_B))}/{float(len(set(_A) | set(_B)))!r}, 6) AS jaccard,
  (SELECT count(*) FROM sensor) AS rows_a, (SELECT count(*) FROM sensor) AS rows_b FROM (""" + _union(
    [f"SELECT '{x}' AS feature, '{'both' if x in _B else 'only_a'}' AS membership" for x in _A] +
    [f"SELECT '{x}' AS feature, 'only_b' AS membership" for x in _B if x not in _A]) + ")"))
def q_compare_feature_sets(spark, sf):
    """Shared / only-a / only-b feature names of two built sets (set operations on name rows), Jaccard, rows."""
    s = X.sensor(spark, sf)
    a = FX.feature_set(s, "temperature_focus")
    b = FX.feature_set(s, "wear_focus")
    na = spark.createDataFrame([(x,) for x in a.columns], "feature string")
    nb = spark.createDataFrame([(x,) for x in b.columns], "feature string")
    both = na.intersect(nb).withColumn("membership", F.lit("both"))
    only_a = na.exceptAll(nb).withColumn("membership", F.lit("only_a"))
    only_b = nb.exceptAll(na).withColumn("membership", F.lit("only_b"))
    names = both.unionByName(only_a).unionByName(only_b)
    inter, union = both.count(), na.union(nb).distinct().count()
    ra, rb = a.count(), b.count()
    return round_doubles(names.select("feature", "membership", F.lit(inter / union).alias("jaccard"),
                                      F.lit(ra).cast("long").alias("rows_a"), F.lit(rb).cast("long").alias("rows_b")))


def _l20_sql():
    drops = _union([f"""SELECT CASE WHEN (SELECT var_samp({a}) FROM eng) >= (SELECT var_samp({b}) FROM eng) THEN '{b}' ELSE '{a}' END
  AS feature FROM eng HAVING abs(corr({a}, {b})) > 0.9""" for a, b in _pairs(_ENG_COLS)])
    parts = [f"""SELECT key, '{x}' AS feature, round(({x} - (SELECT quantile_cont({x}, 0.5) FROM eng))
  / coalesce(nullif((SELECT quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) FROM eng), 0), 1.0), 6) AS value
  FROM eng WHERE '{x}' NOT IN (SELECT feature FROM dr)""" for x in _ENG_COLS]
    return S(_union(parts), _ENG_CTE + ",\ndr AS (" + drops + ")")


@query("prepare_for_model", _l20_sql())
def q_prepare_for_model(spark, sf):
    """L20 ('linear'): drop the C4 removals at 0.9, then robust-scale what is left
    (long form: key, feature, value)."""
    return _prepared_long(eng_frame(spark, sf), _ENG_COLS, "linear")


def _prepared_long(e, cols, kind):
    out = ST.prepare_for_model(e, cols, kind, ["key"])
    left = [x for x in out.columns if x != "key"]
    st = f"stack({len(left)}, " + ", ".join(f"'{x}', `{x}`" for x in left) + ") as (feature, value)"
    return round_doubles(out.selectExpr("key", st))


_L20_COLS = ["torque", "wear", "const"]


@query("prepare_for_model_neural", S(_union([f"""SELECT key, '{x}' AS feature, round(({x} - (SELECT quantile_cont({x}, 0.5) FROM sensor))
  / coalesce(nullif((SELECT quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) FROM sensor), 0), 1.0), 6) AS value FROM sensor"""
                                              for x in ("torque", "wear")])))
def q_prepare_for_model_neural(spark, sf):
    """L20 ('neural'): constant columns removed, then robust scaling (long form)."""
    return _prepared_long(X.sensor(spark, sf).withColumn("const", F.lit(1.0)), _L20_COLS, "neural")


@query("prepare_for_model_tree", S(_union([f"SELECT key, '{x}' AS feature, round(CAST({v} AS DOUBLE), 6) AS value FROM sensor"
                                           for x, v in (("torque", "torque"), ("wear", "wear"), ("const", "1.0"))])))
def q_prepare_for_model_tree(spark, sf):
    """L20 ('tree', 'ensemble' and other kinds): every column as a number (long form)."""
    return _prepared_long(X.sensor(spark, sf).withColumn("const", F.lit(1.0)), _L20_COLS, "tree")


# ---------------------------------------------------------------- G9, G10
def _nb_sql():
    lls = []
    for cls in (0, 1):
        terms = " ".join(f"- 0.5*ln(2*pi()*p{cls}.v_{x}) - ({x} - p{cls}.m_{x})*({x} - p{cls}.m_{x})/(2*p{cls}.v_{x})"
                         for x in SENS)
        lls.append(f"ln(p{cls}.prior) {terms}")
    par = ", ".join(f"avg({x}) AS m_{x}, var_pop({x}) + (SELECT 1e-9*greatest({', '.join(f'var_pop({y})' for y in SENS)}) "
                    f"FROM sensor) AS v_{x}" for x in SENS)
    return S(f"""SELECT key, CASE WHEN ll1 > ll0 THEN 1 ELSE 0 END AS prediction FROM (
  SELECT key, {lls[0]} AS ll0, {lls[1]} AS ll1 FROM sensor,
    (SELECT * FROM prm WHERE cls = 0) p0, (SELECT * FROM prm WHERE cls = 1) p1)""",
             f",\nprm AS (SELECT failure AS cls, count(*)*1.0/(SELECT count(*) FROM sensor) AS prior, {par} FROM sensor GROUP BY failure)")


@query("model_gaussian_nb", _nb_sql())
def q_model_gaussian_nb(spark, sf):
    """Gaussian naive Bayes fitted by one grouped aggregate; prediction = arg max log-likelihood."""
    s = X.sensor(spark, sf)
    params = ST.gaussian_nb_fit(s, SENS, "failure")
    return ST.gaussian_nb_predict(s, params, SENS, "key").select("key", F.col("prediction").cast("int"))


@query("model_linear", S("""SELECT round(regr_slope(mechanical_power, torque), 6) AS slope,
  round(regr_intercept(mechanical_power, torque), 6) AS intercept FROM eng""", _ENG_CTE))
def q_model_linear(spark, sf):
    """Ordinary least squares (pyspark.ml LinearRegression, normal equations, no penalty), one feature."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    e = eng_frame(spark, sf)
    v = VectorAssembler(inputCols=["torque"], outputCol="features").transform(e)
    m = LinearRegression(featuresCol="features", labelCol="mechanical_power", regParam=0.0, solver="normal",
                         standardization=False).fit(v)
    return round_doubles(spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))],
                                               "slope double, intercept double"))


@query("model_ridge", S("""SELECT round(((c + 1)*p - b*q)/d, 6) AS torque, round(((a + 1)*q - b*p)/d, 6) AS speed,
  round(my - ((c + 1)*p - b*q)/d*m1 - ((a + 1)*q - b*p)/d*m2, 6) AS intercept
  FROM (SELECT *, (a + 1)*(c + 1) - b*b AS d FROM (SELECT count(*)*var_pop(torque) AS a, count(*)*covar_pop(torque, speed) AS b,
    count(*)*var_pop(speed) AS c, count(*)*covar_pop(torque, wear_torque_interaction) AS p,
    count(*)*covar_pop(speed, wear_torque_interaction) AS q, avg(torque) AS m1, avg(speed) AS m2, avg(wear_torque_interaction) AS my FROM eng))""",
                        _ENG_CTE))
def q_model_ridge(spark, sf):
    """Ridge (alpha 1) of the wear-torque product on torque and speed, from moments."""
    fit = LN.ridge(LN.moments(eng_frame(spark, sf), ["torque", "speed"], "wear_torque_interaction", standardise=False), 1.0)
    return round_doubles(spark.createDataFrame([(fit.coefficients["torque"], fit.coefficients["speed"], fit.intercept)],
                                               "torque double, speed double, intercept double"))


@query("model_lasso")
def q_model_lasso(spark, sf):
    """Lasso (alpha 1) of the wear-torque product on the other standardised columns, from moments."""
    cols = [x for x in _ENG_COLS if x != "wear_torque_interaction"]
    fit = LN.lasso(LN.moments(eng_frame(spark, sf), cols, "wear_torque_interaction"), 1.0)
    return round_doubles(spark.createDataFrame([(x, w, fit.standardised[x], fit.intercept) for x, w in fit.coefficients.items()],
                                               "feature string, coefficient double, standardised double, intercept double"))
