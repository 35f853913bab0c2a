"""Scoring queries (R2-R16, P9) over the scored sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import features as FX
from vigil.operators import scoring as R
from vigil.plans.catalog import query, r6, rnd
from vigil.sources import fixtures as X

# ---------------------------------------------------------------- shared inputs


def scored_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor readings with the stand-in probability and the R2-R4 columns."""
    s = X.sensor(spark, sf)
    s = s.select("key", "machine_id", "ts", "type", F.col("failure").alias("y"),
                 X._p(X._z(X.SCORERS["rule_a"])).alias("p"))
    return R.annotate(s)


SR_SQL = X.SENSOR_SQL + f""",
sr AS (
  SELECT key, machine_id, ts, type, failure AS y,
         round(1/(1+exp(-{X._z_sql(X.SCORERS['rule_a'])})), 4) AS p
  FROM sensor
),
annot0 AS (
  SELECT *, CAST(p >= 0.5 AS INTEGER) AS prediction,
         least(1.0, abs(p - 0.5)*2*0.9) AS confidence,
         CASE WHEN p >= 0.9 THEN 'CRITICAL' WHEN p >= 0.8 THEN 'HIGH' WHEN p >= 0.6 THEN 'MEDIUM' ELSE 'LOW' END
           AS risk_level
  FROM sr
),
annot AS (
  SELECT *, CASE lower(risk_level)
      WHEN 'low' THEN 'Continue normal operation'
      WHEN 'medium' THEN 'Schedule maintenance within 1 week'
      WHEN 'high' THEN 'Schedule maintenance within 48 hours'
      WHEN 'critical' THEN 'IMMEDIATE maintenance required - Stop operation'
      ELSE 'Review equipment status' END AS recommended_action
  FROM annot0
)"""


def _sql(body: str) -> str:
    return X.with_sql(SR_SQL, body)


# ---------------------------------------------------------------- flagship
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor view -> power and wear features -> failure-risk rule -> risk
    distribution per machine type (S1, F2, F3, R3, R6)."""
    s = X.sensor(spark, sf)
    s = FX.add(s, {**FX.power_cols(), **FX.wear_cols()})
    z = (F.lit(-4.0) + 0.02 * F.col("wear_torque_interaction") + 0.0001 * F.col("mechanical_power")
         + 1.0 * F.col("wear_high"))
    s = s.withColumn("p", rnd(1 / (1 + F.exp(-z)), 4)).withColumn("risk_level", R.risk_level(F.col("p")))
    out = R.risk_distribution(s, by=["type"])
    return out.withColumn("percentage", rnd("percentage"))


FLAGSHIP_SQL = X.with_sql(X.SENSOR_SQL + """,
f AS (
  SELECT type, round(1/(1+exp(-(-4.0 + 0.02*(wear*torque/100) + 0.0001*(torque*(speed*2*pi()/60))
           + 1.0*CAST(wear >= 200 AS INTEGER)))), 4) AS p
  FROM sensor
),
lv AS (
  SELECT type, CASE WHEN p >= 0.9 THEN 'CRITICAL' WHEN p >= 0.8 THEN 'HIGH' WHEN p >= 0.6 THEN 'MEDIUM'
                    ELSE 'LOW' END AS risk_level FROM f
),
levels(risk_level) AS (VALUES ('LOW'), ('MEDIUM'), ('HIGH'), ('CRITICAL')),
types AS (SELECT DISTINCT type FROM lv),
cnt AS (SELECT type, risk_level, count(*) AS n FROM lv GROUP BY ALL),
grid AS (SELECT t.type, l.risk_level, coalesce(c.n, 0) AS count
         FROM types t CROSS JOIN levels l LEFT JOIN cnt c ON c.type = t.type AND c.risk_level = l.risk_level)""",
    "SELECT type, risk_level, count, round(count*100.0/sum(count) OVER (PARTITION BY type), 6) AS percentage FROM grid")

query("risk_by_type", FLAGSHIP_SQL)(flagship)


# ---------------------------------------------------------------- R2-R4
@query("confidence", _sql("SELECT key, p, round(confidence, 6) AS confidence FROM annot"))
def q_confidence(spark, sf):
    d = scored_readings(spark, sf)
    return d.select("key", "p", rnd("confidence").alias("confidence"))


@query("risk_level", _sql("SELECT key, p, risk_level FROM annot"))
def q_risk_level(spark, sf):
    return scored_readings(spark, sf).select("key", "p", "risk_level")


@query("action", _sql("SELECT key, risk_level, recommended_action FROM annot"))
def q_action(spark, sf):
    return scored_readings(spark, sf).select("key", "risk_level", "recommended_action")


# ---------------------------------------------------------------- R5-R9
@query("report_summary", _sql("""SELECT count(*) AS total_equipment,
  count(*) FILTER (WHERE prediction = 1) AS failure_predictions,
  round(count(*) FILTER (WHERE prediction = 1)*100.0/count(*), 6) AS failure_rate_percentage,
  round(avg(p), 6) AS average_failure_probability, round(avg(confidence), 6) AS average_confidence FROM annot"""))
def q_report_summary(spark, sf):
    s = R.report_summary(scored_readings(spark, sf))
    return s.select("total_equipment", "failure_predictions",
                    *[rnd(c).alias(c) for c in ("failure_rate_percentage", "average_failure_probability",
                                                      "average_confidence")])


@query("risk_distribution", _sql("""SELECT l.risk_level, count(a.key) AS count,
  round(count(a.key)*100.0/(SELECT count(*) FROM annot), 6) AS percentage
  FROM (VALUES ('LOW'), ('MEDIUM'), ('HIGH'), ('CRITICAL')) l(risk_level)
  LEFT JOIN annot a ON a.risk_level = l.risk_level GROUP BY l.risk_level"""))
def q_risk_distribution(spark, sf):
    d = R.risk_distribution(scored_readings(spark, sf))
    return d.withColumn("percentage", rnd("percentage"))


@query("action_counts", _sql("SELECT recommended_action, count(*) AS count FROM annot GROUP BY ALL"))
def q_action_counts(spark, sf):
    return R.action_counts(scored_readings(spark, sf))


@query("insights", _sql("""SELECT CAST(row_number() OVER (ORDER BY o) - 1 AS INTEGER) AS position, insight FROM (
  SELECT 0 AS o, printf('%.1f%% of equipment predicted to fail', count(*) FILTER (WHERE prediction = 1)*100.0/count(*)) AS insight
    FROM annot HAVING count(*) FILTER (WHERE prediction = 1) > 0
  UNION ALL SELECT 1, printf('%d equipment require IMMEDIATE attention', count(*) FILTER (WHERE risk_level = 'CRITICAL'))
    FROM annot HAVING count(*) FILTER (WHERE risk_level = 'CRITICAL') > 0
  UNION ALL SELECT 2, printf('%d equipment require maintenance within 48 hours', count(*) FILTER (WHERE risk_level = 'HIGH'))
    FROM annot HAVING count(*) FILTER (WHERE risk_level = 'HIGH') > 0
  UNION ALL SELECT 3, 'Model confidence below threshold - consider data quality review'
    FROM annot HAVING avg(confidence) < 0.7) m"""))
def q_insights(spark, sf):
    return R.insights(scored_readings(spark, sf))


@query("cost_estimate", _sql("""SELECT count(*) FILTER (WHERE prediction = 1)*10000 AS potential_failure_costs,
  (count(*) FILTER (WHERE risk_level = 'CRITICAL') + count(*) FILTER (WHERE risk_level = 'HIGH'))*1000 AS recommended_maintenance_costs,
  greatest(0, count(*) FILTER (WHERE prediction = 1)*10000 - (count(*) FILTER (WHERE risk_level = 'CRITICAL') + count(*) FILTER (WHERE risk_level = 'HIGH'))*1000)
    AS estimated_savings FROM annot"""))
def q_cost_estimate(spark, sf):
    return R.cost_estimate(scored_readings(spark, sf))


# ---------------------------------------------------------------- R10, P9
@query("alerts", _sql("""SELECT key, machine_id, p, risk_level,
  printf('[%s] %s - Risk: %s (%.1f%%) - Action: %s', strftime(ts, '%Y-%m-%d %H:%M:%S'),
         CASE WHEN prediction = 1 THEN 'FAILURE PREDICTED' ELSE 'NORMAL OPERATION' END, risk_level, floor((round(p*10000) + 5)/10)/10,
         recommended_action) AS message
  FROM annot WHERE p >= 0.8"""))
def q_alerts(spark, sf):
    return R.alerts(scored_readings(spark, sf)).select("key", "machine_id", "p", "risk_level", "message")


@query("filter_high_risk", _sql("SELECT key, p, risk_level, recommended_action FROM annot WHERE p > 0.7"))
def q_high_risk(spark, sf):
    return R.high_risk(scored_readings(spark, sf)).select("key", "p", "risk_level", "recommended_action")


# ---------------------------------------------------------------- R11-R16
@query("prediction_rollup", _sql("""SELECT machine_id AS source, count(*) AS total_equipment,
  count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count, count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_risk_count,
  round(avg(p), 6) AS average_failure_probability,
  count(*) FILTER (WHERE risk_level = 'HIGH') + count(*) FILTER (WHERE risk_level = 'CRITICAL') AS immediate_action_required
  FROM annot GROUP BY machine_id"""))
def q_prediction_rollup(spark, sf):
    d = scored_readings(spark, sf).withColumnRenamed("machine_id", "source")
    out = R.prediction_rollup(d, "source")
    return out.withColumn("average_failure_probability", rnd("average_failure_probability"))


_FIN_COLS = ["baseline_annual_failures", "baseline_annual_cost", "prevented_failures", "gross_cost_savings",
             "maintenance_costs", "net_annual_savings", "roi_percentage"]


@query("financial_impact", X.with_sql(X.SENSOR_SQL + """,
s AS (SELECT avg(failure) AS failure_rate, count(*) AS total_samples FROM sensor),
a AS (SELECT failure_rate*total_samples*365/30 AS annual FROM s),
b AS (SELECT annual, annual*0.7 AS prevented FROM a)""", """SELECT
  round(annual, 6) AS baseline_annual_failures, round(annual*10000, 6) AS baseline_annual_cost,
  round(prevented, 6) AS prevented_failures, round(prevented*10000, 6) AS gross_cost_savings,
  round(prevented*1000, 6) AS maintenance_costs, round(prevented*10000 - prevented*1000, 6) AS net_annual_savings,
  round(CASE WHEN prevented*1000 > 0 THEN (prevented*10000 - prevented*1000)/(prevented*1000)*100 ELSE 0.0 END, 6)
    AS roi_percentage FROM b"""))
def q_financial_impact(spark, sf):
    s = X.sensor(spark, sf).agg(F.avg("failure").alias("failure_rate"), F.count(F.lit(1)).alias("total_samples"))
    out = R.financial_impact(s)
    return out.select(*[rnd(c).alias(c) for c in _FIN_COLS])


@query("maintenance_plan", _sql("""SELECT count(*) AS total_equipment,
  count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical, count(*) FILTER (WHERE risk_level = 'HIGH') AS high,
  count(*) FILTER (WHERE risk_level = 'MEDIUM') AS medium, count(*) FILTER (WHERE risk_level = 'LOW') AS low,
  count(*) FILTER (WHERE risk_level IN ('CRITICAL', 'HIGH')) AS technicians_required,
  count(*) FILTER (WHERE risk_level IN ('CRITICAL', 'HIGH'))*4 AS maintenance_hours,
  count(*) FILTER (WHERE risk_level IN ('CRITICAL', 'HIGH'))*1000 AS cost_budget,
  count(*) FILTER (WHERE risk_level = 'CRITICAL')*10000 AS cost_avoidance,
  count(*) FILTER (WHERE risk_level IN ('CRITICAL', 'HIGH', 'MEDIUM'))*1000 AS monthly_maintenance_budget,
  CAST(250.0 AS DOUBLE) AS maintenance_cost_per_hour FROM annot"""))
def q_maintenance_plan(spark, sf):
    return R.maintenance_plan(scored_readings(spark, sf))


@query("throughput", _sql("""SELECT count(*) AS total_predictions,
  round((epoch_us(max(ts)) - epoch_us(min(ts)))/3.6e9, 6) AS uptime_hours,
  round(CASE WHEN (epoch_us(max(ts)) - epoch_us(min(ts)))/3.6e9 > 0
             THEN count(*)/((epoch_us(max(ts)) - epoch_us(min(ts)))/3.6e9) ELSE 0.0 END, 6) AS predictions_per_hour
  FROM annot"""))
def q_throughput(spark, sf):
    t = R.throughput(scored_readings(spark, sf))
    return t.select("total_predictions", rnd("uptime_hours").alias("uptime_hours"),
                    rnd("predictions_per_hour").alias("predictions_per_hour"))


@query("health_score", _sql("""SELECT machine_id, count(*) AS readings, round(100*(1 - avg(p)), 6) AS health_score,
  CASE WHEN 100*(1 - avg(p)) > 80 THEN 'green' WHEN 100*(1 - avg(p)) >= 60 THEN 'yellow' ELSE 'red' END AS status
  FROM annot GROUP BY machine_id"""))
def q_health_score(spark, sf):
    h = R.health_score(scored_readings(spark, sf))
    return h.withColumn("health_score", rnd("health_score"))
