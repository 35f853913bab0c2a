"""Oracle-side SQL text of the feature families (same arithmetic as
``vigil.functions.features``).  Fitted families read their parameters from
the one-row CTEs ``op`` (operational) and ``st`` (statistical)."""

from __future__ import annotations

SENSORS = ["air_temp", "proc_temp", "speed", "torque", "wear"]

MP = "torque*(speed*2*pi()/60)"

TEMPERATURE = {
    "temp_difference": "proc_temp - air_temp",
    "temp_ratio": "proc_temp/nullif(air_temp, 0)",
    "temp_efficiency": "(proc_temp - air_temp)/nullif(air_temp, 0)",
    "temp_volatility": "((proc_temp - 273.15) - (air_temp - 273.15))*((proc_temp - 273.15) - (air_temp - 273.15))",
}
POWER = {
    "mechanical_power": MP,
    "power_density": f"{MP}/nullif(torque + 1e-6, 0)",
    "specific_power": f"{MP}/nullif(speed + 1e-6, 0)",
    "torque_efficiency": "torque/nullif(speed + 1e-6, 0)",
}
WEAR = {
    "wear_low": "CAST(wear < 100 AS INTEGER)",
    "wear_medium": "CAST(wear >= 100 AND wear < 200 AS INTEGER)",
    "wear_high": "CAST(wear >= 200 AS INTEGER)",
    "wear_log": "CASE WHEN wear > -1 THEN ln(1 + wear) END",
    "wear_squared": "wear*wear",
    "wear_speed_interaction": "wear*speed/1000",
    "wear_torque_interaction": "wear*torque/100",
}
_A, _B, _C = "speed/nullif(op.max_speed, 0)", "torque/nullif(op.max_torque, 0)", "wear/nullif(op.max_wear, 0)"
OPERATIONAL = {
    "stress_index": f"({_A} + {_B} + {_C})/3",
    "efficiency_score": f"({_A}*{_B})/nullif({_C} + 0.1, 0)",
}
for _n in ("speed", "torque"):
    OPERATIONAL[f"{_n}_low"] = f"CAST({_n} <= op.{_n}_q1 AS INTEGER)"
    OPERATIONAL[f"{_n}_medium"] = f"CAST({_n} > op.{_n}_q1 AND {_n} <= op.{_n}_q3 AS INTEGER)"
    OPERATIONAL[f"{_n}_high"] = f"CAST({_n} > op.{_n}_q3 AS INTEGER)"
INTERACTION = {
    "temp_speed_interaction": "proc_temp*speed/1000",
    "temp_torque_interaction": "proc_temp*torque/100",
    "speed_torque_ratio": "speed/nullif(torque + 1e-6, 0)",
    "speed_torque_product": "speed*torque/1000",
}
STAT_BASE = {"air_temp": "Air_temperature_K", "proc_temp": "Process_temperature_K", "speed": "Rotational_speed_rpm",
             "torque": "Torque_Nm", "wear": "Tool_wear_min"}
STATISTICAL = {}
for _s in SENSORS:
    _b = STAT_BASE[_s]
    STATISTICAL[f"{_b}_squared"] = f"{_s}*{_s}"
    STATISTICAL[f"{_b}_cubed"] = f"{_s}*{_s}*{_s}"
    STATISTICAL[f"{_b}_log"] = f"CASE WHEN {_s} > -1 THEN ln(1 + {_s}) END"
    STATISTICAL[f"{_b}_sqrt"] = f"CASE WHEN {_s} >= 0 THEN sqrt({_s}) END"
    STATISTICAL[f"{_b}_zscore"] = f"({_s} - st.{_s}_mean)/nullif(st.{_s}_std + 1e-6, 0)"

FAMILIES = {"temperature": TEMPERATURE, "power": POWER, "wear": WEAR, "operational": OPERATIONAL,
            "interaction": INTERACTION, "statistical": STATISTICAL}

OP_CTE = """op AS (SELECT max(speed) AS max_speed, max(torque) AS max_torque, max(wear) AS max_wear,
  quantile_cont(speed, 0.25) AS speed_q1, quantile_cont(speed, 0.75) AS speed_q3,
  quantile_cont(torque, 0.25) AS torque_q1, quantile_cont(torque, 0.75) AS torque_q3 FROM sensor)"""
ST_CTE = "st AS (SELECT " + ", ".join(
    f"avg({s}) AS {s}_mean, stddev_samp({s}) AS {s}_std" for s in SENSORS) + " FROM sensor)"

ENERGY = {
    "avg_temperature": "(proc_temp + air_temp)/2",
    "power_estimate": "torque*speed/9549",
    "energy_specific_power": "(torque*speed/9549)/nullif(wear + 1, 0)",
    "energy_intensity": "(torque*speed/9549)/nullif(speed, 0)",
    "wear_rate": "wear/nullif(speed + 1, 0)",
    "thermal_efficiency": "(proc_temp - air_temp)/nullif(torque*speed/9549, 0)",
    "load_factor": "torque/nullif(speed, 0)",
}


def select_list(cols: dict[str, str], fill: bool = False, rnd: bool = True, int_cols: bool = True) -> str:
    parts = []
    for k, e in cols.items():
        if fill:
            e = f"coalesce(CASE WHEN isnan(CAST({e} AS DOUBLE)) THEN NULL ELSE CAST({e} AS DOUBLE) END, 0.0)"
        if rnd and (fill or not e.startswith("CAST(")):
            e = f"round({e}, 6)"
        parts.append(f"{e} AS {k}")
    return ",\n  ".join(parts)
