"""Stand-in views over the driver's tables (FIXTURES.md section 2).

These only give rows in the schema the jobs expect; they do none of the
jobs' work.  Each view exists twice with the same arithmetic: as a Spark
DataFrame and as a DuckDB SQL CTE used by the oracle.

* ``sensor``   - machine readings from ``lineitem`` (2a)
* ``scored``   - a scored table ``key, y, p, yhat`` from fixed logistic scorers (2b)
* ``scored_many`` - the same for four fixed scorers, keyed by ``model_name``
* ``readings`` - a time series / stream from ``events`` (2c)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.numeric import round_rint


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r6(x: Column) -> Column:
    return round_rint(x, 6)


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_from(table(spark, sf_dir, "lineitem"))


def _low(x: Column, factor: int, bits: int, cut: int) -> Column:
    """A number that equals ``x * factor`` modulo 2^bits; x is multiplied in two
    pieces of ``cut`` and ``bits - cut`` bits, which keeps a long from overflowing."""
    ones = lambda n: F.lit((1 << n) - 1).cast("long")
    high = (F.shiftright(x, cut).bitwiseAND(ones(bits - cut)) * F.lit(factor)).bitwiseAND(ones(bits - cut))
    return x.bitwiseAND(ones(cut)) * F.lit(factor) + F.shiftleft(high, cut)


def reading_key(order: Column, part: Column, supp: Column, line: Column, days: Column) -> Column:
    """The parts in mixed radix (1000003, 1009, 11, 4096).  From 2^63 on, where a
    long ends, the number modulo 2^63: never negative, and days keeps its 12 bits."""
    parts = [x.cast("long") for x in (order, part, supp, line, days)]
    order, part, supp, line, days = parts
    weights = [11099033297 * 4096, 11099 * 4096, 11 * 4096, 4096, 1]
    reach = sum((F.abs(x.cast("double")) * w for x, w in zip(parts[1:], weights[1:])), F.abs(order.cast("double")) * weights[0])
    exact = (((order * 1000003 + part) * 1009 + supp) * 11 + line) * 4096 + days
    upper = (_low(order, 11099033297, 51, 25) + _low(part, 11099, 51, 40) + _low(supp, 11, 51, 45)
             + _low(line, 1, 51, 50) + _low(F.shiftright(days, 12), 1, 51, 50))
    wrapped = F.shiftleft(upper.bitwiseAND((1 << 51) - 1), 12) + days.bitwiseAND(4095)
    return F.when(reach < 9.2e18, exact).otherwise(wrapped)


def sensor_from(li: DataFrame) -> DataFrame:
    """The sensor projection of a lineitem frame (batch or stream)."""
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    key = reading_key(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), days)
    air = 295 + 100 * F.col("l_discount")
    proc = 305 + 100 * F.col("l_tax")
    speed = F.floor(1168 + F.col("l_extendedprice") / 60).cast("double")
    # round(3.8 + 1.45 q, 1) half-up, written exactly: floor(38.5 + 14.5 q) / 10
    torque = F.floor(38.5 + 14.5 * F.col("l_quantity")).cast("double") / 10
    wear = ((F.col("l_partkey") * 37 + F.col("l_linenumber") * 11) % 254).cast("double")
    s = li.select(
        key.alias("key"),
        F.col("l_suppkey").alias("machine_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.when(F.col("l_returnflag") == "A", "L").when(F.col("l_returnflag") == "N", "M")
         .when(F.col("l_returnflag") == "R", "H").alias("type"),
        air.alias("air_temp"), proc.alias("proc_temp"), speed.alias("speed"), torque.alias("torque"),
        wear.alias("wear"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 20) == 0).alias("_twf_gate"),
        (((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 1000) == 0).cast("int").alias("rnf"),
    )
    power = F.col("torque") * F.col("speed") * 2 * F.pi() / 60
    s = s.withColumns({
        "twf": (F.col("wear").between(200, 240) & F.col("_twf_gate")).cast("int"),
        "hdf": ((_r6(F.col("proc_temp") - F.col("air_temp")) < 8.6) & (F.col("speed") < 1250)).cast("int"),
        "pwf": ((_r6(power) < 1000) | (_r6(power) > 23000)).cast("int"),
        "osf": (_r6(F.col("wear") * F.col("torque")) > 16500).cast("int"),
    })
    s = s.withColumn("failure", F.greatest("twf", "hdf", "pwf", "osf"))
    return s.select("key", "machine_id", "ts", "type", "air_temp", "proc_temp", "speed", "torque", "wear",
                    "failure", "twf", "hdf", "pwf", "osf", "rnf")


SENSOR_SQL = """
sensor0 AS (
  SELECT
    ((((l_orderkey*1000003 + l_partkey)*1009 + l_suppkey)*11 + l_linenumber)*4096
       + date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)))::BIGINT AS key,
    l_suppkey AS machine_id,
    CAST(l_shipdate AS TIMESTAMP) AS ts,
    CASE l_returnflag WHEN 'A' THEN 'L' WHEN 'N' THEN 'M' WHEN 'R' THEN 'H' END AS type,
    295 + 100*l_discount AS air_temp,
    305 + 100*l_tax AS proc_temp,
    CAST(floor(1168 + l_extendedprice/60) AS DOUBLE) AS speed,
    CAST(floor(38.5 + 14.5*l_quantity) AS DOUBLE)/10 AS torque,
    CAST((l_partkey*37 + l_linenumber*11) % 254 AS DOUBLE) AS wear,
    ((l_orderkey*7 + l_linenumber) % 20) = 0 AS twf_gate,
    CAST(((l_orderkey*7919 + l_linenumber*104729) % 1000) = 0 AS INTEGER) AS rnf
  FROM lineitem
),
sensor1 AS (
  SELECT *,
    CAST(wear BETWEEN 200 AND 240 AND twf_gate AS INTEGER) AS twf,
    CAST(round(proc_temp - air_temp, 6) < 8.6 AND speed < 1250 AS INTEGER) AS hdf,
    CAST(round(torque*speed*2*pi()/60, 6) < 1000 OR round(torque*speed*2*pi()/60, 6) > 23000 AS INTEGER) AS pwf,
    CAST(round(wear*torque, 6) > 16500 AS INTEGER) AS osf
  FROM sensor0
),
sensor AS (
  SELECT key, machine_id, ts, type, air_temp, proc_temp, speed, torque, wear,
         greatest(twf, hdf, pwf, osf) AS failure, twf, hdf, pwf, osf, rnf
  FROM sensor1
)"""


# The stand-in scorers (weights of z = b0 + b.x on the sensors).
SCORERS = {
    "rule_a": (-2.5, 0.015, 0.06, -0.5, -0.003),
    "rule_b": (-3.0, 0.012, 0.05, -0.3, -0.002),
    "rule_c": (-1.0, 0.010, 0.02, -0.6, -0.004),
    "rule_d": (-4.0, 0.020, 0.08, -0.2, 0.000),
}


def _z(w: tuple) -> Column:
    b0, bw, bt, bd, bs = w
    return (F.lit(b0) + F.lit(bw) * F.col("wear") + F.lit(bt) * F.col("torque")
            + F.lit(bd) * (F.col("proc_temp") - F.col("air_temp")) + F.lit(bs) * (F.col("speed") - 1500))


def _z_sql(w: tuple) -> str:
    b0, bw, bt, bd, bs = w
    return f"({b0} + {bw}*wear + {bt}*torque + {bd}*(proc_temp - air_temp) + {bs}*(speed - 1500))"


def _p(z: Column) -> Column:
    return round_rint(1 / (1 + F.exp(-z)), 4)


def scored(spark: SparkSession, sf_dir: str, scorer: str = "rule_a") -> DataFrame:
    s = sensor(spark, sf_dir)
    p = _p(_z(SCORERS[scorer]))
    return s.select("key", F.col("failure").alias("y"), p.alias("p")).withColumn(
        "yhat", (F.col("p") >= 0.5).cast("int"))


def scored_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long scored table keyed by ``model_name``: one scan, one explode."""
    s = sensor(spark, sf_dir)
    arr = F.array(*[F.struct(F.lit(n).alias("model_name"), _p(_z(w)).alias("p")) for n, w in SCORERS.items()])
    out = s.select("key", F.col("failure").alias("y"), F.explode(arr).alias("m"))
    return out.select(F.col("m.model_name").alias("model_name"), "key", "y", F.col("m.p").alias("p"),
                      (F.col("m.p") >= 0.5).cast("int").alias("yhat"))


SCORED_SQL = SENSOR_SQL + f""",
scored AS (
  SELECT key, failure AS y, round(1/(1+exp(-{_z_sql(SCORERS['rule_a'])})), 4) AS p
  FROM sensor
),
scored2 AS (SELECT key, y, p, CAST(p >= 0.5 AS INTEGER) AS yhat FROM scored)"""

SCORED_MANY_SQL = SENSOR_SQL + ",\nscored_many0 AS (\n" + "\nUNION ALL\n".join(
    f"  SELECT '{n}' AS model_name, key, failure AS y, round(1/(1+exp(-{_z_sql(w)})), 4) AS p FROM sensor"
    for n, w in SCORERS.items()) + """
),
scored_many AS (SELECT model_name, key, y, p, CAST(p >= 0.5 AS INTEGER) AS yhat FROM scored_many0)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("key"), F.col("user_id").alias("machine_id"),
                     F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")


READINGS_SQL = """
readings AS (
  SELECT event_id AS key, user_id AS machine_id, CAST(ts AS TIMESTAMP) AS ts, value, event_type FROM events
)"""


def with_sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def sensor_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor view with injected nulls (FIXTURES.md section 3): torque NULL when
    key % 7 = 0, type NULL when key % 11 = 0, wear NULL when key % 5 < 3."""
    s = sensor(spark, sf_dir)
    return s.withColumns({
        "torque": F.when(F.col("key") % 7 != 0, F.col("torque")),
        "type": F.when(F.col("key") % 11 != 0, F.col("type")),
        "wear": F.when(F.col("key") % 5 >= 3, F.col("wear")),
    })


SENSOR_NULLS_SQL = SENSOR_SQL + """,
sensor_nulls AS (
  SELECT key, machine_id, ts,
    CASE WHEN key % 11 <> 0 THEN type END AS type, air_temp, proc_temp, speed,
    CASE WHEN key % 7 <> 0 THEN torque END AS torque,
    CASE WHEN key % 5 >= 3 THEN wear END AS wear,
    failure, twf, hdf, pwf, osf, rnf
  FROM sensor
)"""
