"""Profiling queries (A1-A24) on the sensor views."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions.features import FAMILIES
from vigil.operators import profile as A
from vigil.plans.catalog import query, rnd, round_doubles
from vigil.sources import fixtures as X

SENS = ["air_temp", "proc_temp", "speed", "torque", "wear"]
MODES = ["twf", "hdf", "pwf", "osf", "rnf"]


def S(body: str) -> str:
    return X.with_sql(X.SENSOR_SQL, body)


def SN(body: str) -> str:
    return X.with_sql(X.SENSOR_NULLS_SQL, body)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@query("describe", S(_union([
    f"""SELECT '{x}' AS "column", count({x}) AS count, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std,
  round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50,
  round(quantile_cont({x}, 0.75), 6) AS q75, round(max({x}), 6) AS max FROM sensor""" for x in SENS])))
def q_describe(spark, sf):
    """A1: numeric summary of the five sensors: moments in one aggregate, exact quartiles from fit_quantiles."""
    return round_doubles(A.describe(X.sensor(spark, sf), SENS))


@query("describe_categorical", X.with_sql(X.SENSOR_NULLS_SQL + """,
vc AS (SELECT type AS value, count(*) AS n FROM sensor_nulls WHERE type IS NOT NULL GROUP BY type)""",
    """SELECT 'type' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  (SELECT value FROM vc ORDER BY n DESC, value LIMIT 1) AS top, max(n) AS freq FROM vc"""))
def q_describe_categorical(spark, sf):
    """A1 (categorical): count, unique, top, freq of the machine type (with nulls)."""
    return A.describe_categorical(X.sensor_nulls(spark, sf), ["type"])


@query("value_counts", S("""SELECT type, count(*) AS count, round(count(*)/sum(count(*)) OVER (), 6) AS share
  FROM sensor GROUP BY type"""))
def q_value_counts(spark, sf):
    """A2: counts and shares per machine type."""
    return round_doubles(A.value_counts(X.sensor(spark, sf), "type"))


@query("group_stats", S("SELECT failure, " + ", ".join(
    f"round(avg({x}), 3) AS {x}_mean, round(stddev_samp({x}), 3) AS {x}_std" for x in SENS)
    + " FROM sensor GROUP BY failure"))
def q_group_stats(spark, sf):
    """A3: per-class mean and sample std of the sensors, rounded to 3."""
    return A.group_stats(X.sensor(spark, sf), "failure", SENS, nd=3)


@query("crosstab", S("""SELECT CASE WHEN grouping(type) = 1 THEN 'All' ELSE type END AS type,
  CASE WHEN grouping(failure) = 1 THEN 'All' ELSE CAST(failure AS VARCHAR) END AS failure, count(*) AS count
  FROM sensor GROUP BY CUBE (type, failure)"""))
def q_crosstab(spark, sf):
    """A4: type x failure contingency with margins (cube)."""
    return A.crosstab(X.sensor(spark, sf), "type", "failure")


@query("rate_by_type", S("""SELECT type, count(*) AS count, round(count(*)*100.0/sum(count(*)) OVER (), 6) AS share_pct,
  count(*) FILTER (WHERE failure = 1) AS failures, count(*) - count(*) FILTER (WHERE failure = 1) AS non_failures,
  round(count(*) FILTER (WHERE failure = 1)*100.0/count(*), 6) AS failure_pct FROM sensor GROUP BY type"""))
def q_rate_by_type(spark, sf):
    """A5: failure rate per machine type."""
    return round_doubles(A.rate_by_group(X.sensor(spark, sf), "type", "failure"))


_NU = ["machine_id", "type", "air_temp", "proc_temp", "speed", "torque", "wear", "failure"]


@query("nunique", S(_union([f"""SELECT '{x}' AS "column", count(DISTINCT {x}) AS nunique FROM sensor""" for x in _NU])))
def q_nunique(spark, sf):
    """Distinct non-null values per column."""
    return A.nunique(X.sensor(spark, sf), _NU)


_QR = ["type", "air_temp", "proc_temp", "speed", "torque", "wear", "failure"]
_QR_T = {"type": "string", "failure": "int"}


@query("quality_report", SN(_union([
    f"""SELECT '{x}' AS "column", '{_QR_T.get(x, 'double')}' AS dtype, count(*) FILTER (WHERE {x} IS NULL) AS nulls,
  round(count(*) FILTER (WHERE {x} IS NULL)*100.0/count(*), 6) AS null_pct, count(DISTINCT {x}) AS "distinct"
  FROM sensor_nulls""" for x in _QR])))
def q_quality_report(spark, sf):
    """Per-column type, nulls, null %, distinct in one pass (null-injected view)."""
    return round_doubles(A.null_profile(X.sensor_nulls(spark, sf), _QR))


_FQ = ["air_temp", "torque", "wear", "const"]


@query("feature_quality", X.with_sql(X.SENSOR_NULLS_SQL + ",\nfq AS (SELECT *, 1.0 AS const FROM sensor_nulls),\nper AS (" + _union([
    f"""SELECT '{x}' AS feature, count(*) FILTER (WHERE {x} IS NULL) AS nulls,
  round(count(*) FILTER (WHERE {x} IS NULL)*1.0/count(*), 6) AS missing_share, count(DISTINCT {x}) AS "distinct",
  count(DISTINCT {x}) <= 1 AS constant, count(*) FILTER (WHERE abs({x}) = 'inf'::DOUBLE) AS infinite,
  count(DISTINCT {x}) > count(*)*0.9 AS high_cardinality,
  count(*) FILTER (WHERE {x} IS NULL)*1.0/count(*) > 0.05 AS high_missing FROM fq""" for x in _FQ]) + ")",
    """SELECT *, constant OR infinite > 0 OR high_cardinality OR high_missing AS has_issue,
  round(1 - count(*) FILTER (WHERE constant OR infinite > 0 OR high_cardinality OR high_missing) OVER () / 4.0, 6)
    AS quality_score FROM per"""))
def q_feature_quality(spark, sf):
    """Feature issues and quality score (null-injected view plus a constant column)."""
    d = X.sensor_nulls(spark, sf).withColumn("const", F.lit(1.0))
    return round_doubles(A.feature_quality(d, _FQ))


def _meta_sql():
    parts = []
    for x in SENS:
        parts.append(f"""SELECT '{x}' AS feature, count(*) FILTER (WHERE {x} IS NULL) AS nulls,
  count(DISTINCT {x}) AS "distinct", round(min({x}), 6) AS min, round(max({x}), 6) AS max, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, round(var_samp({x}), 6) AS var, round(skewness({x}), 6) AS skew,
  round(kurtosis({x}), 6) AS kurtosis FROM sensor""")
    return S(_union(parts))


@query("feature_metadata", _meta_sql())
def q_feature_metadata(spark, sf):
    """Per-feature metadata with bias-corrected skewness and excess kurtosis."""
    m = A.feature_metadata(X.sensor(spark, sf), SENS)
    return round_doubles(m.select("feature", "nulls", "distinct", "min", "max", "mean", "std", "var", "skew", "kurtosis"))


_DUP = ["type", "air_temp", "proc_temp", "torque", "wear"]


@query("duplicates", S(f"""SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM sensor GROUP BY {', '.join(_DUP)})"""))
def q_duplicates(spark, sf):
    """A10: rows beyond the first of each identical (type, temperatures, torque, wear) group."""
    return A.duplicate_count(X.sensor(spark, sf), _DUP)


_CMP = ["type", "air_temp", "proc_temp", "speed", "torque", "wear"]


def _nulls_sum(cols):
    return " + ".join(f"CAST({x} IS NULL AS INTEGER)" for x in cols)


@query("completeness", SN(f"""SELECT round((1 - nc/cells)*100, 6) AS completeness_pct, round(1 - nc/cells, 6) AS completeness,
  round(1 - d/r, 6) AS uniqueness, CASE WHEN 1 - nc/cells > 0.9 THEN 'Good' ELSE 'Fair' END AS overall_quality
  FROM (SELECT CAST(sum({_nulls_sum(_CMP)}) AS DOUBLE) AS nc, CAST(count(*)*{len(_CMP)} AS DOUBLE) AS cells FROM sensor_nulls) a,
       (SELECT CAST(sum(n - 1) AS DOUBLE) AS d, CAST(sum(n) AS DOUBLE) AS r
          FROM (SELECT count(*) AS n FROM sensor_nulls GROUP BY {', '.join(_CMP)})) b"""))
def q_completeness(spark, sf):
    """Cell completeness, uniqueness and verdict (null-injected view)."""
    return round_doubles(A.completeness(X.sensor_nulls(spark, sf), _CMP))


@query("missing_profile", SN(_union([
    f"""SELECT '{x}' AS "column", count(*) FILTER (WHERE {x} IS NULL) AS nulls,
  round(count(*) FILTER (WHERE {x} IS NULL)*100.0/count(*), 6) AS null_pct FROM sensor_nulls""" for x in _CMP])))
def q_missing_profile(spark, sf):
    """Null count and % per column."""
    p = A.null_profile(X.sensor_nulls(spark, sf), _CMP)
    return round_doubles(p.select("column", "nulls", "null_pct"))


@query("missing_summary", SN(f"""SELECT count(*) AS rows, count(*)*{len(_CMP)} AS cells,
  CAST(sum({_nulls_sum(_CMP)}) AS BIGINT) AS null_cells,
  count(*) FILTER (WHERE {' OR '.join(f'{x} IS NULL' for x in _CMP)}) AS rows_with_nulls,
  count(*) FILTER (WHERE NOT ({' OR '.join(f'{x} IS NULL' for x in _CMP)})) AS complete_rows FROM sensor_nulls"""))
def q_missing_summary(spark, sf):
    """A12 totals: cells, null cells, rows with any null, complete rows."""
    return A.missing_summary(X.sensor_nulls(spark, sf), _CMP)


_CO = ["type", "torque", "wear"]


@query("missing_cooccurrence", SN(_union([
    f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
  round(corr(CAST({a} IS NULL AS DOUBLE), CAST({b} IS NULL AS DOUBLE)), 6) AS null_corr FROM sensor_nulls"""
    for i, a in enumerate(_CO) for b in _CO[i + 1:]])))
def q_missing_cooccurrence(spark, sf):
    """Correlation of the null flags of each column pair."""
    return round_doubles(A.missing_cooccurrence(X.sensor_nulls(spark, sf), _CO))


@query("null_patterns", SN("SELECT " + " || ".join(f"CAST(CAST({x} IS NULL AS INTEGER) AS VARCHAR)" for x in _CO)
                         + " AS pattern, count(*) AS count FROM sensor_nulls GROUP BY ALL"))
def q_null_patterns(spark, sf):
    """Null patterns (one 0/1 digit per column) and their counts."""
    return A.null_patterns(X.sensor_nulls(spark, sf), _CO)


@query("class_balance", S("""SELECT count(*) AS classes, max(n) AS majority, min(n) AS minority,
  round(max(n)*1.0/min(n), 6) AS imbalance_ratio, round(min(n)*100.0/sum(n), 6) AS minority_pct,
  round(min(n)*1.0/max(n), 6) AS balance_ratio,
  CASE WHEN min(n)*1.0/max(n) < 0.1 THEN 'severe' WHEN min(n)*1.0/max(n) < 0.3 THEN 'moderate' ELSE 'balanced' END
    AS severity, max(n)*1.0/min(n) > 3 OR min(n)*100.0/sum(n) < 10 AS warn
  FROM (SELECT failure, count(*) AS n FROM sensor GROUP BY failure)"""))
def q_class_balance(spark, sf):
    """Imbalance measures and verdict."""
    return round_doubles(A.class_balance(X.sensor(spark, sf), "failure"))


@query("class_weights", S("""SELECT failure, count(*) AS n_c,
  round((SELECT count(*) FROM sensor)*1.0/(count(*)*(SELECT count(DISTINCT failure) FROM sensor)), 6) AS weight
  FROM sensor GROUP BY failure"""))
def q_class_weights(spark, sf):
    """Balanced class weights n / (k n_c)."""
    return round_doubles(A.class_weights(X.sensor(spark, sf), "failure"))


@query("mode_counts", S(_union([
    f"""SELECT '{m}' AS mode, CAST(sum({m}) AS BIGINT) AS count, round(sum({m})*100.0/count(*), 6) AS pct,
  count(*) FILTER (WHERE {m} = 1 AND failure = 1) AS with_failure FROM sensor""" for m in MODES])))
def q_mode_counts(spark, sf):
    """Per failure mode count, % and co-occurrence with the target."""
    return round_doubles(A.mode_counts(X.sensor(spark, sf), MODES, "failure"))


@query("simultaneous_modes", S(f"SELECT {' + '.join(MODES)} AS modes_set, count(*) AS count FROM sensor GROUP BY ALL"))
def q_simultaneous_modes(spark, sf):
    """Rows by number of modes set."""
    return A.simultaneous_modes(X.sensor(spark, sf), MODES)


@query("target_or_check", S(f"""SELECT count(*) AS rows,
  count(*) FILTER (WHERE failure <> greatest({', '.join(MODES)})) AS mismatches,
  bool_and(failure = greatest({', '.join(MODES)})) AS target_is_or,
  count(*) FILTER (WHERE failure = 1 AND greatest({', '.join(MODES)}) = 0) AS failure_without_mode,
  count(*) FILTER (WHERE failure = 0 AND greatest({', '.join(MODES)}) = 1) AS mode_without_failure FROM sensor"""))
def q_target_or_check(spark, sf):
    """A18 / P11 summary: does the target equal the OR of the modes?"""
    return A.target_or_check(X.sensor(spark, sf), MODES, "failure")


_LBL = "CASE WHEN concat_ws('+', " + ", ".join(f"CASE WHEN {m} = 1 THEN '{m.upper()}' END" for m in MODES) + \
    ") = '' THEN 'No Failure' ELSE concat_ws('+', " + ", ".join(
        f"CASE WHEN {m} = 1 THEN '{m.upper()}' END" for m in MODES) + ") END"


@query("mode_combinations", S(f"""SELECT {_LBL} AS combination, count(*) AS count FROM sensor GROUP BY ALL
  ORDER BY count DESC, combination LIMIT 10"""))
def q_mode_combinations(spark, sf):
    """Top 10 failure-mode combinations (the limit is the feature)."""
    return A.mode_combinations(X.sensor(spark, sf), MODES)


@query("histogram", S("""SELECT failure, CAST(least(floor((torque - lo)/((hi - lo)/30)), 29) AS INTEGER) AS bin,
  count(*) AS count, round(lo + least(floor((torque - lo)/((hi - lo)/30)), 29)*((hi - lo)/30), 6) AS bin_lo,
  round(lo + (least(floor((torque - lo)/((hi - lo)/30)), 29) + 1)*((hi - lo)/30), 6) AS bin_hi
  FROM sensor, (SELECT min(torque) AS lo, max(torque) AS hi FROM sensor) r GROUP BY ALL"""))
def q_histogram(spark, sf):
    """30 equal-width torque bins per class."""
    return round_doubles(A.histogram(X.sensor(spark, sf), "torque", 30, by="failure"))


@query("binned_target", S("""SELECT CAST(least(greatest(ceil((key - lo)/((hi - lo)/10)) - 1, 0), 9) AS INTEGER) AS bin,
  count(*) FILTER (WHERE failure = 0) AS n0, count(*) FILTER (WHERE failure = 1) AS n1
  FROM sensor, (SELECT CAST(min(key) AS DOUBLE) AS lo, CAST(max(key) AS DOUBLE) AS hi FROM sensor) r GROUP BY ALL"""))
def q_binned_target(spark, sf):
    """10 right-closed equal-width key bins x class counts."""
    return A.binned_target(X.sensor(spark, sf), "key", "failure", 10)


@query("boxplot_stats", S("""SELECT s.failure, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(torque) FILTER (WHERE torque BETWEEN q1 - 1.5*(q3 - q1) AND q3 + 1.5*(q3 - q1)), 6) AS whisker_lo,
  round(max(torque) FILTER (WHERE torque BETWEEN q1 - 1.5*(q3 - q1) AND q3 + 1.5*(q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (WHERE NOT (torque BETWEEN q1 - 1.5*(q3 - q1) AND q3 + 1.5*(q3 - q1))) AS outliers
  FROM sensor s JOIN (SELECT failure, quantile_cont(torque, 0.25) AS q1, quantile_cont(torque, 0.5) AS median,
                             quantile_cont(torque, 0.75) AS q3 FROM sensor GROUP BY failure) q ON s.failure = q.failure
  GROUP BY s.failure, q1, median, q3"""))
def q_boxplot_stats(spark, sf):
    """Per-class torque quartiles, whisker ends and outlier count."""
    b = A.boxplot_stats(X.sensor(spark, sf), "torque", "failure")
    return round_doubles(b)


@query("frame_overview", S("""SELECT count(*) AS rows, 15 AS columns, 13 AS numeric_columns, 1 AS string_columns,
  0 AS boolean_columns, 1 AS other_columns FROM sensor"""))
def q_frame_overview(spark, sf):
    """Rows, columns and columns per type of the sensor view."""
    return A.frame_overview(X.sensor(spark, sf))


@query("data_summary", S("""SELECT count(*) AS total_samples, count(*) FILTER (WHERE failure = 1) AS failures,
  round(avg(failure), 6) AS failure_rate, round(avg(torque), 6) AS torque_mean, round(avg(wear), 6) AS wear_mean,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM sensor GROUP BY type, air_temp, proc_temp, torque, wear))
    AS duplicates FROM sensor"""))
def q_data_summary(spark, sf):
    """Dataset info, target rate, feature means and duplicates (A1 + A10 composition)."""
    s = X.sensor(spark, sf)
    head = s.agg(F.count(F.lit(1)).alias("total_samples"), F.count_if(F.col("failure") == 1).alias("failures"),
                 rnd(F.avg("failure")).alias("failure_rate"), rnd(F.avg("torque")).alias("torque_mean"),
                 rnd(F.avg("wear")).alias("wear_mean"))
    dups = A.duplicate_count(s, _DUP).first()["duplicates"]
    return head.withColumn("duplicates", F.lit(dups).cast("long"))
