"""Preparation queries: missing values (M), outliers (O), encoding and scaling
(E), splits (D), projections / predicates (P) and key joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import features as FX
from vigil.operators import prep as PR
from vigil.operators import relational as RL
from vigil.plans.catalog import query, round_doubles
from vigil.sources import fixtures as X

SENS = ["air_temp", "proc_temp", "speed", "torque", "wear"]
MODES = ["twf", "hdf", "pwf", "osf", "rnf"]


def S(body: str, extra: str = "") -> str:
    return X.with_sql(X.SENSOR_SQL + extra, body)


def SN(body: str, extra: str = "") -> str:
    return X.with_sql(X.SENSOR_NULLS_SQL + extra, body)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


_MODE_TYPE = "(SELECT type FROM sensor_nulls WHERE type IS NOT NULL GROUP BY type ORDER BY count(*) DESC, type LIMIT 1)"

# ============================================================== M


@query("impute_auto", SN(f"""SELECT key, coalesce(type, {_MODE_TYPE}) AS type,
  coalesce(torque, (SELECT quantile_cont(torque, 0.5) FROM sensor_nulls)) AS torque, air_temp FROM sensor_nulls"""))
def q_impute_auto(spark, sf):
    """M1: > 50 % null columns dropped (wear), numeric -> median, string -> mode."""
    d = X.sensor_nulls(spark, sf).select("key", "type", "torque", "wear", "air_temp")
    params = PR.fit_impute(d.drop("key"), "auto")
    out = PR.apply_impute(d, params)
    assert "wear" not in out.columns
    return out


@query("impute_drop", SN("SELECT key, type, torque, wear FROM sensor_nulls WHERE type IS NOT NULL AND torque IS NOT NULL AND wear IS NOT NULL"))
def q_impute_drop(spark, sf):
    """M2: rows with any null dropped."""
    return PR.impute_drop(X.sensor_nulls(spark, sf).select("key", "type", "torque", "wear"))


@query("impute_mean_median", SN("""SELECT key, round(coalesce(torque, (SELECT avg(torque) FROM sensor_nulls)), 6) AS torque,
  round(coalesce(wear, (SELECT avg(wear) FROM sensor_nulls)), 6) AS wear FROM sensor_nulls"""))
def q_impute_mean_median(spark, sf):
    """M3: numeric nulls -> column mean."""
    d = X.sensor_nulls(spark, sf).select("key", "torque", "wear")
    return round_doubles(PR.apply_impute(d, PR.fit_impute(d.drop("key"), "mean")))


def _mode_sql(x):
    return f"(SELECT {x} FROM sensor_nulls WHERE {x} IS NOT NULL GROUP BY {x} ORDER BY count(*) DESC, {x} LIMIT 1)"


@query("impute_mode", SN(f"""SELECT key, coalesce(type, {_mode_sql('type')}) AS type,
  coalesce(torque, {_mode_sql('torque')}) AS torque, coalesce(wear, {_mode_sql('wear')}) AS wear FROM sensor_nulls"""))
def q_impute_mode(spark, sf):
    """M4: every column's nulls -> its mode (smallest value on ties)."""
    d = X.sensor_nulls(spark, sf).select("key", "type", "torque", "wear")
    return PR.apply_impute(d, PR.fit_impute(d.drop("key"), "mode"))


@query("impute_ffill", SN("""SELECT key, machine_id, last_value(torque IGNORE NULLS) OVER (PARTITION BY machine_id
  ORDER BY ts, key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS torque FROM sensor_nulls"""))
def q_impute_ffill(spark, sf):
    """M5: forward fill of torque in time order per machine."""
    d = X.sensor_nulls(spark, sf).select("key", "machine_id", "ts", "torque")
    return PR.ffill(d, ["torque"], "machine_id", ["ts", "key"]).drop("ts")


@query("impute_interpolate", SN("""SELECT key, machine_id,
  round(CASE WHEN wear IS NOT NULL THEN wear
       WHEN pp IS NOT NULL AND np IS NOT NULL THEN pv + (nv - pv)*(pos - pp)/(np - pp)
       WHEN pp IS NOT NULL THEN pv END, 6) AS wear
FROM (SELECT key, machine_id, wear, pos,
  last_value(CASE WHEN wear IS NOT NULL THEN pos END IGNORE NULLS) OVER w1 AS pp,
  last_value(wear IGNORE NULLS) OVER w1 AS pv,
  first_value(CASE WHEN wear IS NOT NULL THEN pos END IGNORE NULLS) OVER w2 AS np,
  first_value(wear IGNORE NULLS) OVER w2 AS nv
  FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY ts, key) AS pos FROM sensor_nulls)
  WINDOW w1 AS (PARTITION BY machine_id ORDER BY ts, key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w2 AS (PARTITION BY machine_id ORDER BY ts, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""))
def q_impute_interpolate(spark, sf):
    """M6: linear interpolation of wear by row position per machine."""
    d = X.sensor_nulls(spark, sf).select("key", "machine_id", "ts", "wear")
    return round_doubles(PR.interpolate(d, ["wear"], "machine_id", ["ts", "key"]).drop("ts"))


@query("fill_zero", SN("SELECT key, coalesce(torque, 0.0) AS torque, coalesce(wear, 0.0) AS wear FROM sensor_nulls"))
def q_fill_zero(spark, sf):
    """M7: undefined -> 0."""
    return PR.fill_zero(X.sensor_nulls(spark, sf).select("key", "torque", "wear"), ["torque", "wear"])


# ============================================================== O


def _iqr_sql(flag: bool = False):
    parts = []
    for x in SENS:
        q = f"(SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM sensor)"
        sel = f"""SELECT '{x}' AS "column", round(q1 - 1.5*(q3 - q1), 6) AS lower, round(q3 + 1.5*(q3 - q1), 6) AS upper,
  count(*) FILTER (WHERE {x} < q1 - 1.5*(q3 - q1) OR {x} > q3 + 1.5*(q3 - q1)) AS outliers,
  round(count(*) FILTER (WHERE {x} < q1 - 1.5*(q3 - q1) OR {x} > q3 + 1.5*(q3 - q1))*100.0/count(*), 6) AS outlier_pct
  FROM sensor, {q} b GROUP BY q1, q3"""
        parts.append(sel)
    body = _union(parts)
    if flag:
        body = f"SELECT *, outlier_pct > 2 AS flagged FROM ({body})"
    return S(body)


@query("outlier_iqr", _iqr_sql())
def q_outlier_iqr(spark, sf):
    """O1: values outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] per sensor (two passes, data unchanged)."""
    s = X.sensor(spark, sf)
    return round_doubles(PR.count_outside(s, PR.fit_bounds(s, SENS, "iqr", 1.5)))


@query("outlier_zscore", S(_union([f"""SELECT '{x}' AS "column", round(m, 6) AS mean, round(sd, 6) AS std,
  count(*) FILTER (WHERE abs(({x} - m)/nullif(sd, 0)) > 3.0) AS outliers
  FROM sensor, (SELECT avg({x}) AS m, stddev_samp({x}) AS sd FROM sensor) b GROUP BY m, sd""" for x in SENS])))
def q_outlier_zscore(spark, sf):
    """O2: |z| > 3 with the sample std."""
    return round_doubles(PR.zscore_outliers(X.sensor(spark, sf), SENS, 3.0, ddof=1))


@query("outlier_summary", _iqr_sql(flag=True))
def q_outlier_summary(spark, sf):
    """O3: O1 in long form with the > 2 % flag."""
    s = X.sensor(spark, sf)
    out = PR.count_outside(s, PR.fit_bounds(s, SENS, "iqr", 1.5))
    return round_doubles(out).withColumn("flagged", F.col("outlier_pct") > 2)


@query("clip_outliers", S("""SELECT key,
  CASE WHEN torque IS NULL THEN NULL ELSE greatest(least(torque, t_hi), t_lo) END AS torque,
  CASE WHEN speed IS NULL THEN NULL ELSE greatest(least(speed, s_hi), s_lo) END AS speed
  FROM sensor, (SELECT quantile_cont(torque, 0.015) AS t_lo, quantile_cont(torque, 0.985) AS t_hi,
                       quantile_cont(speed, 0.015) AS s_lo, quantile_cont(speed, 0.985) AS s_hi FROM sensor) b"""))
def q_clip_outliers(spark, sf):
    """Clip into the 1.5 / 98.5 percentile bounds."""
    s = X.sensor(spark, sf)
    bounds = PR.fit_bounds(s, ["torque", "speed"], "percentile", 1.5)
    return round_doubles(PR.clip(s.select("key", "torque", "speed"), bounds))


# ============================================================== E

_PTYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("encode_auto", f"""SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_code,
  {', '.join(f"CAST(p_type = '{t}' AS INTEGER) AS p_type_{t}" for t in _PTYPES[1:])} FROM part""")
def q_encode_auto(spark, sf):
    """By distinct count: 2 -> label code, 3-10 -> one-hot drop-first, > 10 -> label code."""
    part = X.table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    counts = part.agg(*[F.count_distinct(x).alias(x) for x in ("p_brand", "p_type")]).first().asDict()
    out = part
    for col, k in counts.items():
        if 3 <= k <= 10:
            out = PR.onehot(out, col, PR.fit_levels(part, col, 10), drop_first=True)
        else:
            codes = PR.fit_label_index(part, col)
            out = PR.apply_codes(out, codes.withColumn("code", F.col("code").cast("int")), col)
    return out.drop("p_brand", "p_type")


@query("encode_label", "SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_code FROM part")
def q_encode_label(spark, sf):
    """code = index in the sorted distinct values (distributed rank + checked broadcast join)."""
    part = X.table(spark, sf, "part").select("p_partkey", "p_brand")
    codes = PR.fit_label_index(part, "p_brand")
    return PR.apply_codes(part, codes.withColumn("code", F.col("code").cast("int")), "p_brand")


@query("encode_onehot", S("SELECT key, " + ", ".join(f"CAST(type = '{t}' AS INTEGER) AS type_{t}" for t in "HLM") + " FROM sensor"))
def q_encode_onehot(spark, sf):
    """One 0/1 column per machine type level."""
    s = X.sensor(spark, sf).select("key", "type")
    return PR.onehot(s, "type", PR.fit_levels(s, "type")).drop("type")


@query("encode_factorize", """SELECT o_orderkey, o_orderpriority,
  CAST(dense_rank() OVER (ORDER BY first_key, o_orderpriority) - 1 AS INTEGER) AS o_orderpriority_code
  FROM (SELECT o_orderkey, o_orderpriority, min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS first_key FROM orders)""")
def q_encode_factorize(spark, sf):
    """Code by first appearance in order-key order."""
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    codes = PR.fit_first_appearance(o, "o_orderpriority", "o_orderkey")
    return PR.apply_codes(o, codes.withColumn("code", F.col("code").cast("int")), "o_orderpriority")


def _scale_sql(center: str, scale: str):
    cols = ", ".join(f"round(({x} - {center.format(x=x)})/coalesce(nullif({scale.format(x=x)}, 0), 1.0), 6) AS {x}"
                     for x in SENS)
    return S(f"SELECT key, {cols} FROM sensor")


@query("scale_standard", _scale_sql("(SELECT avg({x}) FROM sensor)", "(SELECT stddev_pop({x}) FROM sensor)"))
def q_scale_standard(spark, sf):
    """E5: (x - mean) / population std; zero std -> 1."""
    s = X.sensor(spark, sf).select("key", *SENS)
    return round_doubles(PR.apply_scaler(s, PR.fit_scaler(s, SENS, "standard")))


@query("scale_minmax", _scale_sql("(SELECT min({x}) FROM sensor)", "(SELECT max({x}) - min({x}) FROM sensor)"))
def q_scale_minmax(spark, sf):
    """(x - min) / (max - min); zero range -> 1."""
    s = X.sensor(spark, sf).select("key", *SENS)
    return round_doubles(PR.apply_scaler(s, PR.fit_scaler(s, SENS, "minmax")))


@query("scale_robust", _scale_sql("(SELECT quantile_cont({x}, 0.5) FROM sensor)",
                                  "(SELECT quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) FROM sensor)"))
def q_scale_robust(spark, sf):
    """(x - median) / (Q75 - Q25), exact quantiles; zero range -> 1."""
    s = X.sensor(spark, sf).select("key", *SENS)
    return round_doubles(PR.apply_scaler(s, PR.fit_scaler(s, SENS, "robust")))


# ============================================================== D

_H = PR.split_hash_sql()


def _rank_sql(part: str):
    return f"""SELECT key, failure, row_number() OVER (PARTITION BY {part} ORDER BY {_H}, key) - 1 AS r,
  count(*) OVER (PARTITION BY {part}) AS n FROM sensor"""


_VAL = 0.1 / (1 - 0.2)


@query("split_stratified", S(f"""SELECT key, CASE WHEN r < floor(n*0.2 + 0.5) THEN 'test'
  WHEN r < floor(n*0.2 + 0.5) + floor((n - floor(n*0.2 + 0.5))*{_VAL!r} + 0.5) THEN 'val' ELSE 'train' END AS split
  FROM ({_rank_sql('failure')})"""))
def q_split_stratified(spark, sf):
    """Stratified train / val / test (20 % test, 10 % val), hash order, exact class shares."""
    s = X.sensor(spark, sf).select("key", "failure")
    return PR.split_stratified(s, "failure", "key", 0.2, 0.1).select("key", "split")


@query("kfold_stratified", S(f"SELECT key, CAST(r % 5 AS INTEGER) AS fold FROM ({_rank_sql('failure')})"))
def q_kfold_stratified(spark, sf):
    """Stratified 5-fold assignment (class rank mod 5)."""
    s = X.sensor(spark, sf).select("key", "failure")
    return PR.kfold(s, "failure", "key", 5).select("key", "fold")


@query("kfold_plain", S(f"SELECT key, CAST(r % 5 AS INTEGER) AS fold FROM ({_rank_sql('1')})"))
def q_kfold_plain(spark, sf):
    """D3: plain 5-fold assignment (hash rank mod 5)."""
    s = X.sensor(spark, sf).select("key", "failure")
    return PR.kfold(s, None, "key", 5).select("key", "fold")


# ============================================================== P

_NUMS = ["key", "machine_id", "air_temp", "proc_temp", "speed", "torque", "wear", "failure"] + MODES


@query("select_by_type", S(f"SELECT {', '.join(_NUMS)} FROM sensor"))
def q_select_by_type(spark, sf):
    """The numeric columns."""
    return RL.select_by_type(X.sensor(spark, sf), "numeric")


_RAW = {"key": "UDI", "type": "Type", "air_temp": "Air temperature [K]", "proc_temp": "Process temperature [K]",
        "speed": "Rotational speed [rpm]", "torque": "Torque [Nm]", "wear": "Tool wear [min]", "failure": "Machine failure"}


@query("rename_cols", S("SELECT key, type, air_temp, proc_temp, speed, torque, wear, failure, "
                        "'Air_temperature_K' AS cleaned_air FROM sensor"))
def q_rename_cols(spark, sf):
    """Raw display names -> roles; cleaned identifier of a display name."""
    s = X.sensor(spark, sf).select(*[F.col(k).alias(v) for k, v in _RAW.items()])
    out = RL.rename_cols(s)
    from vigil.functions.roles import clean_name
    return out.withColumn("cleaned_air", F.lit(clean_name("Air temperature [K]")))


@query("drop_leakage", S("SELECT machine_id, type, air_temp, proc_temp, speed, torque, wear FROM sensor"))
def q_drop_leakage(spark, sf):
    """Target, failure modes and ids removed from the feature frame."""
    return RL.drop_leakage(X.sensor(spark, sf)).drop("ts")


@query("features_target", S("SELECT key, torque, wear, failure FROM sensor"))
def q_features_target(spark, sf):
    """Key + chosen features + target (unknown names raise)."""
    return RL.features_target(X.sensor(spark, sf), "failure", ["torque", "wear"], key="key")


@query("feat_baseline", S("SELECT key, air_temp, proc_temp, speed, torque, wear, " +
                          ", ".join(f"CAST(type = '{t}' AS INTEGER) AS type_{t}" for t in "HLM") + " FROM sensor"))
def q_feat_baseline(spark, sf):
    """P5: the five sensors plus the one-hot type columns present."""
    s = X.sensor(spark, sf)
    s = PR.onehot(s, "type", PR.fit_levels(s, "type"))
    return s.select("key", *FX.baseline_names(s))


@query("ensure_numeric", S("""SELECT key, TRY_CAST(CASE WHEN key % 13 = 0 THEN 'n/a' ELSE CAST(wear AS VARCHAR) END AS DOUBLE)
  AS wear_txt FROM sensor"""))
def q_ensure_numeric(spark, sf):
    """Text column coerced to double, failures -> NULL."""
    s = X.sensor(spark, sf).select("key", F.when(F.col("key") % 13 == 0, "n/a")
                                   .otherwise(F.col("wear").cast("string")).alias("wear_txt"))
    return RL.ensure_numeric(s, ["wear_txt"])


@query("align_to_model", S("SELECT key, air_temp, torque, wear, CAST(0.0 AS DOUBLE) AS heat_index FROM sensor"))
def q_align_to_model(spark, sf):
    """Select the trained feature list; an absent feature becomes 0."""
    return RL.align_to_model(X.sensor(spark, sf), ["air_temp", "torque", "wear", "heat_index"], keep=["key"])


_VF = ["air_temp", "torque", "wear"]


@query("validate_inputs", SN("SELECT * FROM (" + _union(
    [f"""SELECT 'null' AS "check", '{x}' AS "column", count(*) FILTER (WHERE {x} IS NULL) AS count FROM sensor_nulls"""
     for x in _VF] +
    [f"""SELECT 'nan', '{x}', count(*) FILTER (WHERE isnan({x})) FROM sensor_nulls""" for x in _VF] +
    [f"""SELECT 'infinite', '{x}', count(*) FILTER (WHERE abs({x}) = 'inf'::DOUBLE) FROM sensor_nulls""" for x in _VF] +
    ["SELECT 'empty', NULL, CAST(count(*) = 0 AS BIGINT) FROM sensor_nulls",
     "SELECT 'null_target', 'failure', count(*) FILTER (WHERE failure IS NULL) FROM sensor_nulls",
     "SELECT 'single_class', 'failure', CAST(count(DISTINCT failure) < 2 AS BIGINT) FROM sensor_nulls",
     "SELECT 'non_numeric_target', 'failure', CAST(0 AS BIGINT)"]) + ") WHERE count > 0"))
def q_validate_inputs(spark, sf):
    """Violation counts (nulls, NaN, infinities, target checks) in one aggregate."""
    return RL.validate_inputs(X.sensor_nulls(spark, sf), _VF, "failure")


@query("filter_discrepancies", S(f"SELECT key, failure, rnf FROM sensor WHERE failure <> greatest({', '.join(MODES)})"))
def q_filter_discrepancies(spark, sf):
    """Rows whose target differs from the OR of the failure modes."""
    return RL.filter_discrepancies(X.sensor(spark, sf), "failure", MODES).select("key", "failure", "rnf")


# ============================================================== J

@query("concat_columns", S("""SELECT key, round(proc_temp - air_temp, 6) AS temp_difference,
  round(wear*wear, 6) AS wear_squared FROM sensor"""))
def q_concat_columns(spark, sf):
    """Two feature frames of the same rows put side by side (full outer join on the key)."""
    s = X.sensor(spark, sf)
    a = s.select("key", (F.col("proc_temp") - F.col("air_temp")).alias("temp_difference"))
    b = s.select("key", (F.col("wear") * F.col("wear")).alias("wear_squared"))
    return round_doubles(RL.concat_columns(a, b, "key"))


@query("align_target", SN("SELECT key, torque, failure FROM sensor_nulls WHERE torque IS NOT NULL"))
def q_align_target(spark, sf):
    """Feature rows (defined torque) inner-joined with the target rows on the key."""
    d = X.sensor_nulls(spark, sf)
    feats = d.where(F.col("torque").isNotNull()).select("key", "torque")
    return RL.align_target(feats, d.select("key", "failure"), "key")


@query("merge_feature_sets", S("""SELECT key, air_temp, torque, round(proc_temp - air_temp, 6) AS temp_difference FROM sensor"""))
def q_merge_feature_sets(spark, sf):
    """Base and engineered frames merged on the key; the base copy of a shared name wins."""
    s = X.sensor(spark, sf)
    base = s.select("key", "air_temp", "torque")
    eng = s.select("key", (F.col("torque") * 2).alias("torque"),
                   (F.col("proc_temp") - F.col("air_temp")).alias("temp_difference"))
    return round_doubles(RL.merge_feature_sets(base, eng, "key", "drop"))


@query("merge_feature_sets_suffix", S("""SELECT key, air_temp AS baseline_air_temp, torque AS baseline_torque,
  round(torque*2, 6) AS engineered_torque FROM sensor"""))
def q_merge_suffix(spark, sf):
    """J3 'suffix' mode: both sides prefixed."""
    s = X.sensor(spark, sf)
    return round_doubles(RL.merge_feature_sets(s.select("key", "air_temp", "torque"),
                                               s.select("key", (F.col("torque") * 2).alias("torque")), "key", "suffix"))


@query("join_labels", X.with_sql(X.SCORED_SQL, "SELECT key, y, yhat FROM scored2"))
def q_join_labels(spark, sf):
    """Predictions paired with the truth on the row key."""
    sc = X.scored(spark, sf)
    matched, _unmatched = RL.join_labels(sc.select("key", "yhat"), sc.select("key", "y"), "key")
    return matched
