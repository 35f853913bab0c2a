"""Feature queries (F1-F17) on the sensor view."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import features as FX
from vigil.plans import sql_features as SF
from vigil.plans.catalog import query, rnd, round_doubles
from vigil.sources import fixtures as X


def _fam_sql(cols: dict, ctes: str = "", fill: bool = False) -> str:
    extra = (",\n" + ctes) if ctes else ""
    frm = "sensor" + (", op" if "op." in str(cols) else "") + (", st" if "st." in str(cols) else "")
    return X.with_sql(X.SENSOR_SQL + extra, f"SELECT key,\n  {SF.select_list(cols, fill=fill)}\nFROM {frm}")


def _family_query(family: str):
    def fn(spark, sf):
        s = X.sensor(spark, sf)
        params = FX.fit_extended(s) if family in ("operational", "statistical") else None
        cols = FX.family_cols(family, params)
        return round_doubles(s.select("key", *[v.alias(k) for k, v in cols.items()]))
    fn.__doc__ = f"F: the {family} feature family on every sensor row."
    return fn


_CTES = {"operational": SF.OP_CTE, "statistical": SF.ST_CTE}
for _key, _fam in (("feat_temperature", "temperature"), ("feat_power", "power"), ("feat_wear", "wear"),
                   ("feat_operational", "operational"), ("feat_interaction", "interaction"),
                   ("feat_statistical", "statistical")):
    query(_key, _fam_sql(SF.FAMILIES[_fam], _CTES.get(_fam, "")))(_family_query(_fam))


_ALL_ENG = {k: v for fam in SF.FAMILIES.values() for k, v in fam.items()}


@query("feat_extended", _fam_sql(_ALL_ENG, SF.OP_CTE + ",\n" + SF.ST_CTE, fill=True))
def q_feat_extended(spark, sf):
    """all 52 engineered columns in one projection, NaN / NULL -> 0."""
    s = X.sensor(spark, sf)
    out = FX.feature_set(s, "engineered_only", keep=["key"])
    return round_doubles(out)


_WEAR_FOCUS = {**{k: k for k in SF.SENSORS}, **SF.WEAR, **SF.OPERATIONAL}


@query("feat_set", _fam_sql(_WEAR_FOCUS, SF.OP_CTE))
def q_feat_set(spark, sf):
    """F8: the 'wear_focus' set from the registry (baseline + wear + operational)."""
    s = X.sensor(spark, sf)
    return round_doubles(FX.feature_set(s, "wear_focus", keep=["key"]))


def _catalog_sql() -> str:
    parts = []
    for fam, cols in SF.FAMILIES.items():
        cond = " AND ".join(f"({e}) IS NOT NULL" for e in cols.values())
        parts.append(f"SELECT '{fam}' AS family, {len(cols)} AS n_features, count(*) FILTER (WHERE {cond}) AS rows_complete "
                     f"FROM sensor, op, st")
    return X.with_sql(X.SENSOR_SQL + ",\n" + SF.OP_CTE + ",\n" + SF.ST_CTE, "\nUNION ALL\n".join(parts))


@query("feat_catalog", _catalog_sql())
def q_feat_catalog(spark, sf):
    """features per family counted from the built columns, plus rows where
    every feature of the family is defined (one aggregate over all families)."""
    s = X.sensor(spark, sf)
    params = FX.fit_extended(s)
    aggs, fams = [], []
    for fam in FX.FAMILIES:
        cols = FX.family_cols(fam, params)
        fams.append((fam, len(cols)))
        cond = F.lit(True)
        for v in cols.values():
            cond = cond & v.isNotNull()
        aggs.append(F.count_if(cond).alias(fam))
    wide = s.agg(*aggs)
    stack = "stack({}, {}) as (family, n_features, rows_complete)".format(
        len(fams), ", ".join(f"'{f}', {n}, `{f}`" for f, n in fams))
    return wide.selectExpr(stack)


@query("feat_energy", _fam_sql(SF.ENERGY))
def q_feat_energy(spark, sf):
    """notebook energy / efficiency features."""
    s = X.sensor(spark, sf)
    return round_doubles(s.select("key", *[v.alias(k) for k, v in FX.energy_cols().items()]))


@query("feat_failure_agg", X.with_sql(X.SENSOR_SQL, """SELECT key, twf + hdf + pwf + osf + rnf AS total_failure_modes,
  twf + osf AS mechanical_failure_risk, hdf AS thermal_failure_risk, pwf AS electrical_failure_risk,
  rnf AS random_failure_risk FROM sensor"""))
def q_feat_failure_agg(spark, sf):
    """failure-mode aggregates per row."""
    s = X.sensor(spark, sf)
    return s.select("key", *[v.alias(k) for k, v in FX.failure_group_cols().items()])


@query("feat_prevented", X.with_sql(X.SENSOR_SQL, """SELECT
  count(*) FILTER (WHERE greatest(twf, hdf, pwf, osf, rnf) > 0 AND failure = 0) AS prevented_count,
  round(count(*) FILTER (WHERE greatest(twf, hdf, pwf, osf, rnf) > 0 AND failure = 0)*100.0
        / nullif(CAST(sum(twf + hdf + pwf + osf + rnf) AS BIGINT), 0), 6) AS prevention_rate
  FROM sensor"""))
def q_feat_prevented(spark, sf):
    """prevented-failure flag, count and rate over all mode flags."""
    s = X.sensor(spark, sf).withColumn("prevented_failure", FX.prevented_flag())
    modes = sum(F.col(m) for m in ("twf", "hdf", "pwf", "osf", "rnf"))
    out = s.agg(F.sum("prevented_failure").cast("long").alias("prevented_count"),
                F.sum(modes).cast("long").alias("mode_flags"))
    return out.select("prevented_count", rnd(F.try_divide(F.col("prevented_count") * 100.0, F.col("mode_flags")))
                      .alias("prevention_rate"))


@query("log_safe", X.with_sql(X.SENSOR_SQL + """,
mn AS (SELECT min(temp_difference) AS m FROM (SELECT proc_temp - air_temp - 8 AS temp_difference FROM sensor)),
sh AS (SELECT CASE WHEN m <= 0 THEN abs(m) + 1e-6 ELSE 1e-6 END AS s FROM mn)""",
    """SELECT key, round(CASE WHEN proc_temp - air_temp - 8 + s > -1 THEN ln(1 + (proc_temp - air_temp - 8 + s)) END, 6)
  AS temp_margin_log_safe FROM sensor, sh"""))
def q_log_safe(spark, sf):
    """shifted log of a column with negatives (temperature margin over 8 K)."""
    s = X.sensor(spark, sf).select("key", (F.col("proc_temp") - F.col("air_temp") - 8).alias("temp_margin"))
    shifts = FX.fit_log_shift(s, ["temp_margin"])
    return round_doubles(s.select("key", *[v.alias(k) for k, v in FX.log_safe_cols(shifts).items()]))


@query("sqrt_signed", X.with_sql(X.SENSOR_SQL, """SELECT key,
  round(sign(proc_temp - air_temp - 10)*sqrt(abs(proc_temp - air_temp - 10)), 6) AS margin_sqrt FROM sensor"""))
def q_sqrt_signed(spark, sf):
    """signed square root of the temperature margin over 10 K."""
    s = X.sensor(spark, sf)
    return round_doubles(s.select("key", FX.sqrt_signed(F.col("proc_temp") - F.col("air_temp") - 10)
                                  .alias("margin_sqrt")))


def _poly_sql() -> str:
    names = ["torque", "wear", "speed"]
    terms = FX.polynomial_terms(names, 2)
    sel = ", ".join(f'round({"*".join(f)}, 6) AS "{label}"' for label, f in terms)
    return X.with_sql(X.SENSOR_SQL, f"SELECT key, {sel} FROM sensor")


@query("poly_features", _poly_sql())
def q_poly_features(spark, sf):
    """F16: degree-2 expansion of torque, wear, speed."""
    s = X.sensor(spark, sf)
    return round_doubles(FX.poly_features(s, ["torque", "wear", "speed"], degree=2, keep=["key"]))


@query("custom_features", X.with_sql(X.SENSOR_SQL, """SELECT key,
  round((proc_temp - air_temp)*torque, 6) AS heat_load FROM sensor"""))
def q_custom_features(spark, sf):
    """a user frame -> frame function applied through the registry hook."""
    def heat_load(df):
        return df.select("key", ((F.col("proc_temp") - F.col("air_temp")) * F.col("torque")).alias("heat_load"))
    return round_doubles(FX.custom_features(X.sensor(spark, sf), heat_load))


_SET_WIDTH = {k: (5 if b else 0) + sum(len(SF.FAMILIES[f]) for f in fams) for k, (b, fams) in FX.FEATURE_SETS.items()}


@query("feat_all_sets", X.with_sql(X.SENSOR_SQL, "SELECT feature_set, n_features, (SELECT count(*) FROM sensor) AS rows FROM (VALUES "
                        + ", ".join(f"('{k}', {v})" for k, v in _SET_WIDTH.items()) + ") t(feature_set, n_features)"))
def q_feat_all_sets(spark, sf):
    """all five registered sets built from one fitted parameter set, written to one
    table partitioned by set, and read back per set (rows and width)."""
    from vigil.session import work_dir

    s = X.sensor(spark, sf)
    params = FX.fit_extended(s)
    root = work_dir(spark, "feature_sets")
    widths = {}
    for kind in FX.FEATURE_SETS:
        fs = FX.feature_set(s, kind, params=params, keep=["key"])
        widths[kind] = len(fs.columns) - 1
        fs.write.parquet(f"{root}/feature_set={kind}")
    back = spark.read.option("basePath", root).parquet(*[f"{root}/feature_set={k}" for k in FX.FEATURE_SETS])
    counts = back.groupBy("feature_set").agg(F.count(F.lit(1)).alias("rows"))
    width = F.create_map(*[v for k, n in widths.items() for v in (F.lit(k), F.lit(n))])
    return counts.select("feature_set", width[F.col("feature_set")].alias("n_features"), "rows")
