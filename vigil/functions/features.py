"""Domain features (F1-F17) as JVM-side column expressions.

Each ``*_cols`` function returns an ordered ``{name: Column}`` dict, so a
feature family is one ``withColumns`` (one projection, inside whole-stage
codegen).  Families that need statistics of the data (F4 maxima and
quartiles, F6 mean / std, F14 minimum) are split into ``fit_*`` - a single
``agg`` whose one-row result is the parameter set - and the expressions that
take those parameters as literals, so scoring reuses training parameters.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.roles import DEFAULT, Roles

EPS = 1e-6


def c(name: str) -> Column:
    return F.col(f"`{name}`")


def div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 (ANSI mode raises on a zero divisor)."""
    return F.try_divide(a, b)


def log1p_guarded(x: Column) -> Column:
    """ln(1 + x), NULL where undefined (x <= -1)."""
    return F.when(x > -1, F.log1p(x))


def sqrt_guarded(x: Column) -> Column:
    return F.when(x >= 0, F.sqrt(x))


def as_int(cond: Column) -> Column:
    return cond.cast("int")


# ---------------------------------------------------------------- F1 temperature
def temperature_cols(r: Roles = DEFAULT) -> dict[str, Column]:
    ta, tp = c(r.air_temp), c(r.proc_temp)
    diff = tp - ta
    return {
        "temp_difference": diff,
        "temp_ratio": div(tp, ta),
        "temp_efficiency": div(diff, ta),
        "temp_volatility": ((tp - 273.15) - (ta - 273.15)) * ((tp - 273.15) - (ta - 273.15)),
    }


# ---------------------------------------------------------------- F2 power
def mechanical_power(r: Roles = DEFAULT) -> Column:
    return c(r.torque) * (c(r.speed) * 2 * F.pi() / 60)


def power_cols(r: Roles = DEFAULT) -> dict[str, Column]:
    n, tq = c(r.speed), c(r.torque)
    p = mechanical_power(r)
    return {
        "mechanical_power": p,
        "power_density": div(p, tq + EPS),
        "specific_power": div(p, n + EPS),
        "torque_efficiency": div(tq, n + EPS),
    }


# ---------------------------------------------------------------- F3 wear
def wear_cols(r: Roles = DEFAULT) -> dict[str, Column]:
    w, n, tq = c(r.wear), c(r.speed), c(r.torque)
    return {
        "wear_low": as_int(w < 100),
        "wear_medium": as_int((w >= 100) & (w < 200)),
        "wear_high": as_int(w >= 200),
        "wear_log": log1p_guarded(w),
        "wear_squared": w * w,
        "wear_speed_interaction": w * n / 1000,
        "wear_torque_interaction": w * tq / 100,
    }


# ---------------------------------------------------------------- F4 operational
def fit_operational(df: DataFrame, r: Roles = DEFAULT) -> dict[str, float]:
    """Maxima (one aggregate) and exact linear quartiles of speed and torque."""
    from vigil.functions.ordering import fit_quantiles

    row = df.agg(F.max(c(r.speed)).alias("max_speed"), F.max(c(r.torque)).alias("max_torque"),
                 F.max(c(r.wear)).alias("max_wear")).first()
    q = fit_quantiles(df, [r.speed, r.torque], [0.25, 0.75])
    qs, qt = q[r.speed], q[r.torque]
    return {"max_speed": row["max_speed"], "max_torque": row["max_torque"], "max_wear": row["max_wear"],
            "speed_q1": qs[0], "speed_q3": qs[1], "torque_q1": qt[0], "torque_q3": qt[1]}


def operational_cols(params: dict, r: Roles = DEFAULT) -> dict[str, Column]:
    n, tq, w = c(r.speed), c(r.torque), c(r.wear)
    a = div(n, F.lit(params["max_speed"]).cast("double"))
    b = div(tq, F.lit(params["max_torque"]).cast("double"))
    cc = div(w, F.lit(params["max_wear"]).cast("double"))
    out = {"stress_index": (a + b + cc) / 3, "efficiency_score": div(a * b, cc + 0.1)}
    for name, col in (("speed", n), ("torque", tq)):
        q1, q3 = F.lit(params[f"{name}_q1"]), F.lit(params[f"{name}_q3"])
        out[f"{name}_low"] = as_int(col <= q1)
        out[f"{name}_medium"] = as_int((col > q1) & (col <= q3))
        out[f"{name}_high"] = as_int(col > q3)
    return out


# ---------------------------------------------------------------- F5 interaction
def interaction_cols(r: Roles = DEFAULT) -> dict[str, Column]:
    tp, n, tq = c(r.proc_temp), c(r.speed), c(r.torque)
    return {
        "temp_speed_interaction": tp * n / 1000,
        "temp_torque_interaction": tp * tq / 100,
        "speed_torque_ratio": div(n, tq + EPS),
        "speed_torque_product": n * tq / 1000,
    }


# ---------------------------------------------------------------- F6 statistical
def fit_statistical(df: DataFrame, r: Roles = DEFAULT) -> dict[str, float]:
    aggs = []
    for s in r.sensors:
        aggs += [F.avg(c(s)).alias(f"{s}_mean"), F.stddev_samp(c(s)).alias(f"{s}_std")]
    return df.agg(*aggs).first().asDict()


# Output names follow the source's "<raw column>_<op>" form (cleaned), which also
# keeps them apart from the wear family's wear_squared / wear_log.
STAT_BASE = {"air_temp": "Air_temperature_K", "proc_temp": "Process_temperature_K", "speed": "Rotational_speed_rpm",
             "torque": "Torque_Nm", "wear": "Tool_wear_min"}


def statistical_cols(params: dict, r: Roles = DEFAULT) -> dict[str, Column]:
    out = {}
    for role, s in zip(DEFAULT.sensors, r.sensors):
        x, b = c(s), STAT_BASE[role]
        out[f"{b}_squared"] = x * x
        out[f"{b}_cubed"] = x * x * x
        out[f"{b}_log"] = log1p_guarded(x)
        out[f"{b}_sqrt"] = sqrt_guarded(x)
        std = params.get(f"{s}_std")
        out[f"{b}_zscore"] = div(x - F.lit(params.get(f"{s}_mean")), F.lit(std).cast("double") + EPS)
    return out


# ---------------------------------------------------------------- F7 / F8 sets
FAMILY_SIZES = {"temperature": 4, "power": 4, "wear": 7, "operational": 8, "interaction": 4, "statistical": 25}


def fit_extended(df: DataFrame, r: Roles = DEFAULT) -> dict:
    """Parameters of every fitted family (two small aggregates)."""
    return {"operational": fit_operational(df, r), "statistical": fit_statistical(df, r)}


def family_cols(family: str, params: dict | None, r: Roles = DEFAULT) -> dict[str, Column]:
    if family == "temperature":
        return temperature_cols(r)
    if family == "power":
        return power_cols(r)
    if family == "wear":
        return wear_cols(r)
    if family == "operational":
        return operational_cols(params["operational"], r)
    if family == "interaction":
        return interaction_cols(r)
    if family == "statistical":
        return statistical_cols(params["statistical"], r)
    raise ValueError(f"unknown feature family {family!r}")


FAMILIES = ["temperature", "power", "wear", "operational", "interaction", "statistical"]


def fill_undefined(cols: dict[str, Column]) -> dict[str, Column]:
    """NaN and NULL -> 0 (the extended set's fill; -inf stays undefined -> 0 too)."""
    return {k: F.coalesce(F.nanvl(v.cast("double"), F.lit(None).cast("double")), F.lit(0.0)) for k, v in cols.items()}


def baseline_names(df: DataFrame, r: Roles = DEFAULT) -> list[str]:
    """P5: the five sensors plus any one-hot ``type_*`` / ``Type_*`` columns present."""
    names = [s for s in r.sensors if s in df.columns]
    names += [x for x in df.columns if x.lower().startswith(f"{r.type.lower()}_") and x not in names]
    return names


# Feature-set registry (F8): set name -> families appended to the baseline.
FEATURE_SETS = {
    "baseline": (True, []),
    "extended": (True, FAMILIES),
    "engineered_only": (False, FAMILIES),
    "temperature_focus": (True, ["temperature", "power"]),
    "wear_focus": (True, ["wear", "operational"]),
}


def feature_set(df: DataFrame, kind: str = "baseline", params: dict | None = None, keep: list[str] | None = None,
                r: Roles = DEFAULT) -> DataFrame:
    """F8: one projection holding ``keep`` columns (e.g. key, target) + the set.

    Unknown set names fall back to the baseline, as in the source.  Engineered
    families are NaN/NULL -> 0 filled (F7).
    """
    with_base, families = FEATURE_SETS.get(kind, FEATURE_SETS["baseline"])
    if any(f in ("operational", "statistical") for f in families) and params is None:
        params = fit_extended(df, r)
    cols: dict[str, Column] = {}
    for k in keep or []:
        cols[k] = c(k)
    if with_base:
        for b in baseline_names(df, r):
            cols[b] = c(b)
    eng: dict[str, Column] = {}
    for fam in families:
        eng.update(family_cols(fam, params, r))
    if kind in ("extended", "engineered_only"):
        eng = fill_undefined(eng)
    cols.update(eng)
    return df.select(*[v.alias(k) for k, v in cols.items()])


# ---------------------------------------------------------------- F11-F13 notebook features
def energy_cols(r: Roles = DEFAULT) -> dict[str, Column]:
    ta, tp, n, tq, w = (c(x) for x in r.sensors)
    kw = tq * n / 9549
    return {
        "avg_temperature": (tp + ta) / 2,
        "power_estimate": kw,
        "energy_specific_power": div(kw, w + 1),
        "energy_intensity": div(kw, n),
        "wear_rate": div(w, n + 1),
        "thermal_efficiency": div(tp - ta, kw),
        "load_factor": div(tq, n),
    }


def failure_group_cols(r: Roles = DEFAULT) -> dict[str, Column]:
    twf, hdf, pwf, osf, rnf = (c(m) for m in r.modes)
    return {
        "total_failure_modes": twf + hdf + pwf + osf + rnf,
        "mechanical_failure_risk": twf + osf,
        "thermal_failure_risk": hdf,
        "electrical_failure_risk": pwf,
        "random_failure_risk": rnf,
    }


def prevented_flag(r: Roles = DEFAULT) -> Column:
    """any failure mode set while the target says no failure (RNF included, as in the source)."""
    any_mode = F.greatest(*[c(m) for m in r.modes]) > 0
    return as_int(any_mode & (c(r.target) == 0))


# ---------------------------------------------------------------- F14-F16 utilities
def fit_log_shift(df: DataFrame, cols: list[str], const: float = 1e-6) -> dict[str, float]:
    """shift = abs(min) + const if min <= 0 else const."""
    row = df.agg(*[F.min(c(x)).alias(x) for x in cols]).first()
    out = {}
    for x in cols:
        m = row[x]
        out[x] = (abs(m) + const) if (m is not None and m <= 0) else const
    return out


def log_safe_cols(shifts: dict[str, float]) -> dict[str, Column]:
    return {f"{x}_log_safe": log1p_guarded(c(x) + F.lit(s)) for x, s in shifts.items()}


def sqrt_signed(x: Column) -> Column:
    """sign(x) * sqrt(|x|)."""
    return F.signum(x) * F.sqrt(F.abs(x))


def polynomial_terms(names: list[str], degree: int = 2, interaction_only: bool = False,
                     max_features: int = 1000) -> list[tuple[str, list[str]]]:
    """F16 term list: degree 1 first, then degree 2 ... in lexicographic index order.

    Returned as (output name, factor list); names follow ``a``, ``a^2``, ``a b``.
    """
    import itertools

    terms: list[tuple[str, list[str]]] = []
    idx = list(range(len(names)))
    for d in range(1, degree + 1):
        combos = itertools.combinations(idx, d) if interaction_only else itertools.combinations_with_replacement(idx, d)
        for combo in combos:
            counts: dict[int, int] = {}
            for i in combo:
                counts[i] = counts.get(i, 0) + 1
            label = " ".join(names[i] if k == 1 else f"{names[i]}^{k}" for i, k in counts.items())
            terms.append((label, [names[i] for i in combo]))
    return terms[:max_features]


def poly_features(df: DataFrame, cols: list[str], degree: int = 2, interaction_only: bool = False,
                  max_features: int = 1000, keep: list[str] | None = None, top: int = 10) -> DataFrame:
    """F16: polynomial expansion as generated columns.

    With more than ``top`` inputs only the ``top`` highest-variance columns are
    expanded (variances from one ``agg``).
    """
    if len(cols) > top:
        var = df.agg(*[F.var_samp(c(x)).alias(x) for x in cols]).first().asDict()
        cols = sorted(cols, key=lambda x: (-(var[x] if var[x] is not None else -math.inf), cols.index(x)))[:top]
    exprs = [c(k) for k in keep or []]
    for label, factors in polynomial_terms(cols, degree, interaction_only, max_features):
        e = c(factors[0])
        for f in factors[1:]:
            e = e * c(f)
        exprs.append(e.alias(label))
    return df.select(*exprs)


def custom_features(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """a user frame -> frame function in the chain."""
    return df.transform(fn)


def add(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.withColumns(cols)
