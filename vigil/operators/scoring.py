"""Scoring and operational reporting.

All of it is column expressions and small aggregates over a scored table
(``p`` the failure probability, ``prediction`` the class).  Nothing leaves
the executors: report figures are one-row DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Risk bands, actions and business constants of the scoring flow.
RISK_THRESHOLDS = {"low": 0.3, "medium": 0.6, "high": 0.8, "critical": 0.9}
BUSINESS_ACTIONS = {
    "low": "Continue normal operation",
    "medium": "Schedule maintenance within 1 week",
    "high": "Schedule maintenance within 48 hours",
    "critical": "IMMEDIATE maintenance required - Stop operation",
}
DEFAULT_ACTION = "Review equipment status"
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
MODEL_UNCERTAINTY = 0.1
HIGH_RISK_P = 0.7
ALERT_THRESHOLD = 0.8
ALERT_COOLDOWN_MINUTES = 30
COST_PER_FAILURE = 10000
COST_PER_MAINTENANCE = 1000
PRODUCTION_VALUE_PER_HOUR = 5000
MAINTENANCE_HOURS = 4
PREVENTION_SHARE = 0.7


def confidence(p: Column, uncertainty: float = MODEL_UNCERTAINTY) -> Column:
    """R2: min(1, 2 |p - 0.5| (1 - u))."""
    return F.least(F.lit(1.0), F.abs(p - 0.5) * 2 * (1 - uncertainty))


def risk_level(p: Column, th: dict = RISK_THRESHOLDS) -> Column:
    """Inclusive bands; the 'low' entry is not a cut."""
    return (F.when(p >= th["critical"], "CRITICAL").when(p >= th["high"], "HIGH")
            .when(p >= th["medium"], "MEDIUM").otherwise("LOW"))


def action(level: Column, actions: dict = BUSINESS_ACTIONS) -> Column:
    """Level -> text; unknown levels get the default action."""
    e = F.when(F.lit(False), F.lit(None))
    for k, v in actions.items():
        e = e.when(F.lower(level) == k, v)
    return e.otherwise(DEFAULT_ACTION)


def annotate(df: DataFrame, p: str = "p", prediction: str | None = None) -> DataFrame:
    """Adds prediction (p >= .5 when absent), confidence, risk_level, recommended_action."""
    cols = {}
    if prediction is None:
        cols["prediction"] = (F.col(p) >= 0.5).cast("int")
    cols["confidence"] = confidence(F.col(p))
    cols["risk_level"] = risk_level(F.col(p))
    df = df.withColumns(cols)
    return df.withColumn("recommended_action", action(F.col("risk_level")))


def report_summary(scored: DataFrame, p: str = "p", prediction: str = "prediction") -> DataFrame:
    """Total, failures, failure rate %, mean probability, mean confidence."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_equipment"),
        F.count_if(F.col(prediction) == 1).alias("failure_predictions"),
        F.try_divide(F.count_if(F.col(prediction) == 1) * 100.0, F.count(F.lit(1))).alias("failure_rate_percentage"),
        F.avg(p).alias("average_failure_probability"),
        F.avg("confidence").alias("average_confidence"),
    )


def risk_distribution(scored: DataFrame, by: list[str] | None = None, level: str = "risk_level") -> DataFrame:
    """Count and % for all four levels (zeros kept), optionally per group.

    Pivot with the fixed level list (no distinct job, no cross join), then
    unpivot; the share uses a window over the small per-group result only.
    """
    by = by or []
    if by:
        wide = scored.groupBy(*by).pivot(level, RISK_LEVELS).count().fillna(0, subset=RISK_LEVELS)
    else:
        wide = scored.agg(*[F.count_if(F.col(level) == lv).alias(lv) for lv in RISK_LEVELS])
    stack = "stack(4, " + ", ".join(f"'{lv}', `{lv}`" for lv in RISK_LEVELS) + ") as (risk_level, count)"
    long = wide.selectExpr(*[f"`{b}`" for b in by], stack)
    total = F.sum("count").over(Window.partitionBy(*by)) if by else F.sum("count").over(Window.partitionBy())
    return long.withColumn("count", F.col("count").cast("long")).withColumn(
        "percentage", F.try_divide(F.col("count") * 100.0, total))


def action_counts(scored: DataFrame) -> DataFrame:
    """R7."""
    return scored.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("count"))


def insights(scored: DataFrame, p: str = "p", prediction: str = "prediction") -> DataFrame:
    """Business insight messages from the R5 / R6 figures (one aggregate pass)."""
    j = scored.agg(
        F.count_if(F.col(prediction) == 1).alias("failure_predictions"),
        F.try_divide(F.count_if(F.col(prediction) == 1) * 100.0, F.count(F.lit(1))).alias("failure_rate_percentage"),
        F.count_if(F.col("risk_level") == "CRITICAL").alias("CRITICAL"),
        F.count_if(F.col("risk_level") == "HIGH").alias("HIGH"),
        F.avg("confidence").alias("average_confidence"))
    msgs = F.array(
        F.when(F.col("failure_predictions") > 0,
               F.format_string("%.1f%% of equipment predicted to fail", F.col("failure_rate_percentage"))),
        F.when(F.col("CRITICAL") > 0, F.format_string("%d equipment require IMMEDIATE attention", F.col("CRITICAL"))),
        F.when(F.col("HIGH") > 0, F.format_string("%d equipment require maintenance within 48 hours", F.col("HIGH"))),
        F.when(F.col("average_confidence") < 0.7,
               F.lit("Model confidence below threshold - consider data quality review")),
    )
    return j.select(F.posexplode(F.filter(msgs, lambda m: m.isNotNull())).alias("position", "insight"))


def level_counts(scored: DataFrame, level: str = "risk_level") -> DataFrame:
    """One row: counts per risk level plus total and predicted failures."""
    return scored.agg(F.count(F.lit(1)).alias("total"),
                      F.count_if(F.col("prediction") == 1).alias("failures"),
                      *[F.count_if(F.col(level) == lv).alias(lv.lower()) for lv in RISK_LEVELS])


def cost_estimate(scored: DataFrame) -> DataFrame:
    """Failure cost, maintenance cost of critical + high, savings (floored at 0)."""
    c = level_counts(scored)
    fail = F.col("failures") * COST_PER_FAILURE
    maint = (F.col("critical") + F.col("high")) * COST_PER_MAINTENANCE
    return c.select(fail.alias("potential_failure_costs"), maint.alias("recommended_maintenance_costs"),
                    F.greatest(F.lit(0).cast("long"), fail - maint).alias("estimated_savings"))


def business_message(ts: Column, prediction: Column, p: Column, level: Column, act: Column) -> Column:
    """'[ts] FAILURE PREDICTED - Risk: LEVEL (p%) - Action: ...'."""
    text = F.when(prediction == 1, "FAILURE PREDICTED").otherwise("NORMAL OPERATION")
    return F.format_string("[%s] %s - Risk: %s (%.1f%%) - Action: %s",
                           F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), text, level, pct1(p), act)


def pct1(p: Column) -> Column:
    """Probability as a percentage rounded half-up to 0.1 (via whole basis points,
    so the rounding does not depend on the binary form of p * 100)."""
    return F.floor((F.rint(p * 10000) + 5) / 10) / 10


def alerts(scored: DataFrame, threshold: float = ALERT_THRESHOLD, ts: str = "ts") -> DataFrame:
    """One alert row per reading with p >= threshold."""
    a = scored.where(F.col("p") >= threshold)
    return a.withColumn("message", business_message(F.col(ts), F.col("prediction"), F.col("p"),
                                                    F.col("risk_level"), F.col("recommended_action")))


def high_risk(scored: DataFrame, threshold: float = HIGH_RISK_P) -> DataFrame:
    """Strictly above 0.7."""
    return scored.where(F.col("p") > threshold)


def prediction_rollup(scored: DataFrame, source: str = "source") -> DataFrame:
    """Per source totals, high / critical counts, mean probability."""
    hi = F.count_if(F.col("risk_level") == "HIGH")
    cr = F.count_if(F.col("risk_level") == "CRITICAL")
    return scored.groupBy(source).agg(
        F.count(F.lit(1)).alias("total_equipment"), hi.alias("high_risk_count"), cr.alias("critical_risk_count"),
        F.avg("p").alias("average_failure_probability"), (hi + cr).alias("immediate_action_required"))


def financial_impact(summary: DataFrame, rate: str = "failure_rate", n: str = "total_samples") -> DataFrame:
    """Annualised failures (monthly data), 70 % prevented, savings and ROI."""
    annual = F.col(rate) * F.col(n) * 365 / 30
    prevented = annual * PREVENTION_SHARE
    gross = prevented * COST_PER_FAILURE
    maint = prevented * COST_PER_MAINTENANCE
    net = gross - maint
    return summary.select(
        annual.alias("baseline_annual_failures"), (annual * COST_PER_FAILURE).alias("baseline_annual_cost"),
        prevented.alias("prevented_failures"), gross.alias("gross_cost_savings"), maint.alias("maintenance_costs"),
        net.alias("net_annual_savings"),
        F.when(maint > 0, net / maint * 100).otherwise(F.lit(0.0)).alias("roi_percentage"))


def maintenance_plan(scored: DataFrame) -> DataFrame:
    """Per-level totals (true counts), technicians, hours, budgets, cost avoidance."""
    c = level_counts(scored)
    urgent = F.col("critical") + F.col("high")
    return c.select(
        F.col("total").alias("total_equipment"), "critical", "high", "medium", "low",
        urgent.alias("technicians_required"), (urgent * MAINTENANCE_HOURS).alias("maintenance_hours"),
        (urgent * COST_PER_MAINTENANCE).alias("cost_budget"),
        (F.col("critical") * COST_PER_FAILURE).alias("cost_avoidance"),
        ((urgent + F.col("medium")) * COST_PER_MAINTENANCE).alias("monthly_maintenance_budget"),
        F.lit(COST_PER_MAINTENANCE / MAINTENANCE_HOURS).alias("maintenance_cost_per_hour"))


def throughput(predictions: DataFrame, ts: str = "ts") -> DataFrame:
    """Predictions, span in hours of the prediction timestamps, predictions per hour."""
    span = (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / 3.6e9
    return predictions.agg(F.count(F.lit(1)).alias("total_predictions"), span.alias("uptime_hours")).withColumn(
        "predictions_per_hour", F.when(F.col("uptime_hours") > 0, F.col("total_predictions") / F.col("uptime_hours"))
        .otherwise(F.lit(0.0)))


def health_score(scored: DataFrame, machine: str = "machine_id") -> DataFrame:
    """100 (1 - mean p) per machine; green > 80, yellow 60-80, red < 60."""
    h = scored.groupBy(machine).agg(F.count(F.lit(1)).alias("readings"), (100 * (1 - F.avg("p"))).alias("health_score"))
    return h.withColumn("status", F.when(F.col("health_score") > 80, "green")
                        .when(F.col("health_score") >= 60, "yellow").otherwise("red"))
