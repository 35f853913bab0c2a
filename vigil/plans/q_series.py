"""Sequence and streaming queries (W1, W2, ST1-ST4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.numeric import round_rint
from vigil.operators import scoring as R
from vigil.operators import sequence as SQ
from vigil.plans.catalog import query, round_doubles
from vigil.plans.q_scoring import SR_SQL
from vigil.session import work_dir
from vigil.sources import fixtures as X
from vigil.streaming import stream as STR

ALERT_VALUE = 100.0


def reading_risk(value) -> F.Column:
    """Risk of a reading: logistic in (value - 100) / 25, 4 decimals (p >= .5 <=> value >= 100)."""
    return round_rint(1 / (1 + F.exp(-(value - ALERT_VALUE) / 25)), 4)


_RISK_SQL = "round(1/(1 + exp(-(value - 100.0)/25)), 4)"


def readings_from(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("event_id").alias("key"), F.col("user_id").alias("machine_id"),
                     F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")


def _text(seq):
    return F.array_join(F.transform(seq, lambda v: F.rint(v * 100).cast("long").cast("string")), ",")


# ---------------------------------------------------------------- W1 / W2
_SEQ_SQL = X.with_sql(X.READINGS_SQL, """SELECT key, machine_id, array_to_string(s, ',') AS seq_text{label} FROM (
  SELECT key, machine_id, value, list(CAST(round(value*100) AS BIGINT)) OVER (PARTITION BY machine_id ORDER BY ts, key
    ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS s FROM readings) WHERE len(s) = 10""")


@query("sequences", _SEQ_SQL.format(label=""))
def q_sequences(spark, sf):
    """The 10 previous readings (current excluded) per machine, rows with a full window only."""
    s = SQ.sequences(X.readings(spark, sf), "machine_id", ["ts", "key"], "value", 10)
    return s.select("key", "machine_id", _text(F.col("seq")).alias("seq_text"))


@query("sequence_labels", _SEQ_SQL.format(label=", CAST(value >= 100 AS INTEGER) AS label"))
def q_sequence_labels(spark, sf):
    """Each full window paired with the label (alert) of the row it precedes."""
    s = SQ.sequences(X.readings(spark, sf), "machine_id", ["ts", "key"], "value", 10,
                     label=(F.col("value") >= ALERT_VALUE).cast("int"))
    return s.select("key", "machine_id", _text(F.col("seq")).alias("seq_text"), "label")


# ---------------------------------------------------------------- ST1
def score_plan(li: DataFrame) -> DataFrame:
    s = X.sensor_from(li).select("key", F.col("failure").alias("y"), X._p(X._z(X.SCORERS["rule_a"])).alias("p"))
    return R.annotate(s).select("key", "p", "risk_level", "recommended_action")


@query("stream_score", X.with_sql(SR_SQL, "SELECT key, p, risk_level, recommended_action FROM annot"))
def q_stream_score(spark, sf):
    """ST1: the batch scoring plan over a file stream of line items (availableNow, parquet sink)."""
    schema = X.table(spark, sf, "lineitem").schema
    src = STR.file_stream(spark, sf, "lineitem.parque[t]", schema)
    return STR.run_available(STR.stream_score(src, score_plan), "stream_score")


# ---------------------------------------------------------------- ST2
_ST2_SQL = """WITH RECURSIVE al AS (SELECT user_id AS machine_id, event_id AS key, CAST(ts AS TIMESTAMP) AS ts, value
                                  FROM events WHERE value >= 100),
chain(machine_id, key, ts, value) AS (
  SELECT machine_id, arg_min(key, (ts, key)), min(ts), arg_min(value, (ts, key)) FROM al GROUP BY machine_id
  UNION ALL
  SELECT c.machine_id,
    (SELECT arg_min(a.key, (a.ts, a.key)) FROM al a WHERE a.machine_id = c.machine_id AND a.ts >= c.ts + INTERVAL 30 MINUTE),
    (SELECT min(a.ts) FROM al a WHERE a.machine_id = c.machine_id AND a.ts >= c.ts + INTERVAL 30 MINUTE),
    (SELECT arg_min(a.value, (a.ts, a.key)) FROM al a WHERE a.machine_id = c.machine_id AND a.ts >= c.ts + INTERVAL 30 MINUTE)
  FROM chain c WHERE c.key IS NOT NULL)
SELECT machine_id, key, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text, value FROM chain WHERE key IS NOT NULL"""


@query("stream_alerts", _ST2_SQL)
def q_stream_alerts(spark, sf):
    """ST2: alerts (value >= 100) per machine, suppressed within 30 minutes of an emitted
    alert; keyed state in applyInPandasWithState, expiring by event time.  The events
    land in four drops in time order, one micro-batch each (the same stream resumes after
    each drop, of any number of files), so state crosses batches."""
    ev = X.table(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = ev.select(us.alias("us")).agg(F.percentile_approx("us", [0.25, 0.5, 0.75])).first()[0]
    base = work_dir(spark, "stream_alerts")
    landing = f"{base}/landing"
    for i, (lo, hi) in enumerate(zip([None, *cuts], [*cuts, None])):
        part = ev.where((us > lo) if lo is not None else F.lit(True)).where((us <= hi) if hi is not None else F.lit(True))
        part.write.parquet(f"{landing}/drop{i}")
        src = readings_from(STR.file_stream(spark, landing, "*/*.parquet", ev.schema))
        out = STR.run_available(STR.stream_alerts(src.where(F.col("value") >= ALERT_VALUE)), "stream_alerts", keep=base)
    return out.select("machine_id", "key", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"), "value")


# ---------------------------------------------------------------- ST3 / ST4
def _windows_sql(rows: str, extra: str = "") -> str:
    ts_fmt = "'%Y-%m-%d %H:%M:%S'"
    return f"""WITH r0 AS (SELECT user_id AS machine_id, CAST(ts AS TIMESTAMP) AS ts, value, {_RISK_SQL} AS p
                 FROM events {extra}),
r AS (SELECT *, epoch_us(ts) AS us FROM r0),
mx AS (SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM r0),
tumb AS (SELECT 'tumbling' AS kind, machine_id, make_timestamp(CAST(floor(us/3600e6)*3600e6 AS BIGINT)) AS ws,
                make_timestamp(CAST(floor(us/3600e6)*3600e6 AS BIGINT)) + INTERVAL 1 HOUR AS we, p FROM r),
slid AS (SELECT 'sliding' AS kind, machine_id, ws, ws + INTERVAL 1 HOUR AS we, p FROM (
           SELECT machine_id, p, us, make_timestamp(CAST(floor(us/900e6)*900e6 - k*900e6 AS BIGINT)) AS ws
           FROM r, range(0, 4) t(k))),
sess0 AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY machine_id ORDER BY ts) IS NULL
             OR ts - lag(ts) OVER (PARTITION BY machine_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS brk FROM r),
sess1 AS (SELECT *, sum(brk) OVER (PARTITION BY machine_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM sess0),
sess AS (SELECT 'session' AS kind, machine_id, min(ts) OVER (PARTITION BY machine_id, sid) AS ws,
                max(ts) OVER (PARTITION BY machine_id, sid) + INTERVAL 30 MINUTE AS we, p FROM sess1),
allw AS ({rows})
SELECT kind, machine_id, strftime(ws, {ts_fmt}) AS window_start, strftime(we, {ts_fmt}) AS window_end, count(*) AS n,
  count(*) FILTER (WHERE p >= 0.5) AS alerts, round(avg(p), 6) AS mean_p
FROM allw, mx WHERE we <= wm GROUP BY kind, machine_id, ws, we"""


def _fmt(df: DataFrame) -> DataFrame:
    f = "yyyy-MM-dd HH:mm:ss"
    return round_doubles(df.select("kind", "machine_id", F.date_format("window_start", f).alias("window_start"),
                                   F.date_format("window_end", f).alias("window_end"), "n", "alerts", "mean_p"))


@query("stream_risk_windows", _windows_sql("SELECT * FROM tumb UNION ALL SELECT * FROM slid UNION ALL SELECT * FROM sess"))
def q_stream_risk_windows(spark, sf):
    """ST3: tumbling, sliding and session windows of reading risk per machine (watermark 10 min,
    append mode: windows are emitted once the watermark passes their end)."""
    schema = X.table(spark, sf, "events").schema
    named = {}
    for kind in ("tumbling", "sliding", "session"):
        src = readings_from(STR.file_stream(spark, sf, "events.parque[t]", schema))
        src = src.withColumn("p", reading_risk(F.col("value")))
        named[f"stream_windows_{kind}"] = STR.risk_windows(src, kind)
    outs = list(STR.run_available_many(named).values())
    out = outs[0].unionByName(outs[1]).unionByName(outs[2])
    return _fmt(out)


@query("stream_late", _windows_sql("SELECT * FROM tumb",
                                   "WHERE ts >= (SELECT quantile_disc(ts, 0.5) FROM events)"))
def q_stream_late(spark, sf):
    """ST4: readings land in two drops - the later half of the month first, then the
    earlier half - and the same stream (one checkpoint) runs after each drop.  The
    second drop is older than the watermark and is dropped from the windows."""
    ev = X.table(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    mid = ev.select(us.alias("us")).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY us)")).first()[0]
    base = work_dir(spark, "late")
    landing = f"{base}/landing"

    def run():
        src = readings_from(STR.file_stream(spark, landing, "*/*.parquet", ev.schema))
        src = src.withColumn("p", reading_risk(F.col("value")))
        return STR.run_available(STR.risk_windows(src, "tumbling"), "stream_late", keep=base)

    ev.where(us >= F.lit(mid)).write.parquet(f"{landing}/drop1")
    run()
    ev.where(us < F.lit(mid)).write.parquet(f"{landing}/drop2")
    return _fmt(run())
