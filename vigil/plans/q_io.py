"""Source and sink queries (S1-S11, S13); each writes derived input to the
shared work folder, reads it back through the library and reports it."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import features as FX
from vigil.operators import evaluation as V
from vigil.operators import prep as PR
from vigil.operators import profile as A
from vigil.operators import scoring as R
from vigil.plans import sql_features as SF
from vigil.plans.catalog import query, round_doubles
from vigil.plans.q_eval import _MANY_CTE, metrics_many
from vigil.plans.q_scoring import SR_SQL, scored_readings
from vigil.functions.cache import keep as hold
from vigil.session import work_dir
from vigil.sources import files as IO
from vigil.sources import fixtures as X

_H = PR.split_hash_sql()


def raw_sensor(spark, sf):
    """The sensor view under its raw display names (the source CSV layout)."""
    s = X.sensor(spark, sf)
    return s.select(F.col("key").alias("UDI"), F.concat(F.col("type"), F.col("machine_id").cast("string")).alias("Product ID"),
                    F.col("type").alias("Type"), F.col("air_temp").alias("Air temperature [K]"),
                    F.col("proc_temp").alias("Process temperature [K]"), F.col("speed").alias("Rotational speed [rpm]"),
                    F.col("torque").alias("Torque [Nm]"), F.col("wear").alias("Tool wear [min]"),
                    F.col("failure").alias("Machine failure"), F.col("twf").alias("TWF"), F.col("hdf").alias("HDF"),
                    F.col("pwf").alias("PWF"), F.col("osf").alias("OSF"), F.col("rnf").alias("RNF"))


def S(body, extra=""):
    return X.with_sql(X.SENSOR_SQL + extra, body)


@query("scan_csv", S("SELECT key, product_id, type, air_temp, proc_temp, speed, torque, wear, failure FROM "
                     "(SELECT *, type || CAST(machine_id AS VARCHAR) AS product_id FROM sensor)"))
def q_scan_csv(spark, sf):
    """Raw sensor CSV (header, explicit schema) read and mapped to roles."""
    path = work_dir(spark, "sensor_csv")
    IO.sink_table(raw_sensor(spark, sf), path, "csv")
    df = IO.scan_csv(spark, path)
    return df.select("key", "product_id", "type", "air_temp", "proc_temp", "speed", "torque", "wear", "failure")


@query("scan_dir", S("""SELECT CASE WHEN type = 'L' THEN 'line_L' ELSE 'line_MH' END AS folder, count(*) AS rows,
  count(*) FILTER (WHERE failure = 1) AS failures FROM sensor GROUP BY ALL"""))
def q_scan_dir(spark, sf):
    """A folder of CSV files (two production lines) read whole, rows per source folder."""
    root = work_dir(spark, "sensor_dir")
    raw = raw_sensor(spark, sf)
    IO.sink_table(raw.where(F.col("Type") == "L"), f"{root}/line_L", "csv")
    IO.sink_table(raw.where(F.col("Type") != "L"), f"{root}/line_MH", "csv")
    df = IO.scan_dir(spark, root)
    df = df.withColumn("folder", F.regexp_extract("file_path", r"/(line_[A-Z]+)/[^/]+$", 1))
    return df.groupBy("folder").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Machine failure") == 1).alias("failures"))


@query("scan_predictions", X.with_sql(SR_SQL, """SELECT 'type_' || type AS source, count(*) AS total_equipment,
  count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count, count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_risk_count,
  round(avg(p), 6) AS average_failure_probability,
  count(*) FILTER (WHERE risk_level IN ('HIGH', 'CRITICAL')) AS immediate_action_required FROM annot GROUP BY ALL"""))
def q_scan_predictions(spark, sf):
    """S3: prediction records written as JSON per machine type, read back (folder -> source), rolled up."""
    root = work_dir(spark, "predictions")
    d = scored_readings(spark, sf)
    rec = d.select("key", "prediction", F.col("p").alias("probability"), "confidence", "risk_level", "recommended_action",
                   F.lit("rule_a").alias("model_name"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                   F.create_map(F.lit("p"), F.col("p")).alias("input_features"), "type")
    rec.write.partitionBy("type").mode("overwrite").json(root)
    back = IO.scan_predictions(spark, root).withColumn("source", F.regexp_replace("source", "=", "_"))
    out = R.prediction_rollup(back.withColumnRenamed("probability", "p"), "source")
    return round_doubles(out)


@query("scan_any", S("""SELECT fmt, count(*) AS rows, round(sum(torque), 6) AS torque_sum
  FROM sensor, (VALUES ('csv'), ('json'), ('parquet')) f(fmt) GROUP BY fmt"""))
def q_scan_any(spark, sf):
    """The same rows as csv, json and parquet, each read by its path suffix."""
    root = work_dir(spark, "any")
    d = X.sensor(spark, sf).select("key", "torque")
    outs = []
    for fmt in ("csv", "json", "parquet"):
        path = f"{root}/readings.{fmt}"
        IO.sink_table(d, path, fmt)
        back = IO.scan_any(spark, path, d.schema)
        outs.append(back.agg(F.lit(fmt).alias("fmt"), F.count(F.lit(1)).alias("rows"), F.sum("torque").alias("torque_sum")))
    return round_doubles(outs[0].unionByName(outs[1]).unionByName(outs[2]))


def reading_lines(spark, sf):
    """Reading text lines from the sensor rows: most with 5 fields, every 17th key
    without its wear field, every 19th with a non-numeric torque."""
    s = X.sensor(spark, sf)
    tq = F.when(F.col("key") % 19 == 0, F.lit("n/a")).otherwise(F.col("torque").cast("string"))
    five = F.concat_ws(",", F.col("air_temp").cast("string"), F.col("proc_temp").cast("string"),
                       F.col("speed").cast("string"), tq, F.col("wear").cast("string"))
    four = F.concat_ws(",", F.col("air_temp").cast("string"), F.col("proc_temp").cast("string"),
                       F.col("speed").cast("string"), tq)
    return s.select("key", F.when(F.col("key") % 17 == 0, four).otherwise(five).alias("value"))


@query("parse_readings", S("""SELECT key, CASE WHEN n = 5 THEN air_temp END AS air_temp, CASE WHEN n = 5 THEN proc_temp END AS proc_temp,
  CASE WHEN n = 5 THEN speed END AS speed, CASE WHEN n = 5 THEN tq END AS torque, CASE WHEN n = 5 THEN wear END AS wear,
  CASE WHEN n <> 5 THEN air_temp END AS feature_0, CASE WHEN n <> 5 THEN tq END AS feature_3, n AS n_fields,
  tq IS NULL AS corrupt FROM (
  SELECT key, CASE WHEN key % 17 = 0 THEN 4 ELSE 5 END AS n, air_temp, proc_temp, speed, wear,
         CASE WHEN key % 19 = 0 THEN NULL ELSE torque END AS tq FROM sensor)"""))
def q_parse_readings(spark, sf):
    """Reading lines parsed in bulk: 5 fields -> named sensors, other lengths -> features[i],
    non-numeric fields -> NULL with the line kept in _corrupt."""
    p = IO.parse_readings(reading_lines(spark, sf))
    return p.select("key", "air_temp", "proc_temp", "speed", "torque", "wear", F.get("features", F.lit(0)).alias("feature_0"),
                    F.get("features", F.lit(3)).alias("feature_3"), "n_fields",
                    F.col("_corrupt").isNotNull().alias("corrupt"))


@query("sink_table", S("""SELECT count(*) AS rows, round(sum(torque), 6) AS torque_sum, CAST(sum(failure) AS BIGINT) AS failures
  FROM sensor"""))
def q_sink_table(spark, sf):
    """Processed rows written as parquet and read back (round trip)."""
    path = work_dir(spark, "processed")
    IO.sink_table(X.sensor(spark, sf).drop("ts"), path)
    back = spark.read.parquet(path)
    return round_doubles(back.agg(F.count(F.lit(1)).alias("rows"), F.sum("torque").alias("torque_sum"),
                                  F.sum("failure").cast("long").alias("failures")))


_WF = {**{k: k for k in SF.SENSORS}, **SF.WEAR, **SF.OPERATIONAL}


@query("feature_store", S("SELECT key, " + SF.select_list(_WF) + " FROM sensor, op", ",\n" + SF.OP_CTE))
def q_feature_store(spark, sf):
    """Two feature sets saved with metadata and quality (partitioned by set), one loaded back."""
    root = work_dir(spark, "feature_store")
    s = X.sensor(spark, sf)
    for kind in ("temperature_focus", "wear_focus"):
        fs = FX.feature_set(s, kind, keep=["key"])
        cols = [c for c in fs.columns if c != "key"]
        IO.save_feature_set(fs, kind, root, metadata=A.describe(fs, cols), quality=A.missing_summary(fs, cols))
    back, meta = IO.load_feature_set(spark, "wear_focus", root, with_metadata=True)
    assert meta is not None
    return round_doubles(back)


@query("sink_predictions", X.with_sql(SR_SQL, """SELECT printf('[%s] %s - Risk: %s (%.1f%%) - Action: %s',
  strftime(ts, '%Y-%m-%d %H:%M:%S'), CASE WHEN prediction = 1 THEN 'FAILURE PREDICTED' ELSE 'NORMAL OPERATION' END,
  risk_level, floor((round(p*10000) + 5)/10)/10, recommended_action) AS value FROM annot WHERE p >= 0.8"""))
def q_sink_predictions(spark, sf):
    """Alert messages written as text lines and read back."""
    path = work_dir(spark, "messages")
    IO.sink_predictions(R.alerts(scored_readings(spark, sf)), path, "text")
    return spark.read.text(path)


@query("sink_splits", S(f"""SELECT key, failure FROM (SELECT key, failure,
  row_number() OVER (PARTITION BY failure ORDER BY {_H}, key) - 1 AS r, count(*) OVER (PARTITION BY failure) AS n FROM sensor)
  WHERE r < floor(n*0.2 + 0.5)"""))
def q_sink_splits(spark, sf):
    """Train / val / test in one table partitioned by split; the test partition read back (pruned)."""
    path = work_dir(spark, "splits")
    sp = PR.split_stratified(X.sensor(spark, sf).select("key", "failure"), "failure", "key", 0.2, 0.1)
    IO.sink_table(sp, path, partition_by=["split"])
    return spark.read.parquet(path).where(F.col("split") == "test").select("key", "failure")


@query("experiment_log", X.with_sql(X.SCORED_MANY_SQL + _MANY_CTE, """SELECT model_name, round(accuracy, 6) AS accuracy,
  round(f1, 6) AS f1, 'exp_cd' AS experiment_id FROM metrics WHERE model_name IN ('rule_c', 'rule_d')"""))
def q_experiment_log(spark, sf):
    """Metric rows of two runs appended to the experiment table; one run read back."""
    root = work_dir(spark, "experiments")
    m = hold(metrics_many(spark, sf).select("model_name", "accuracy", "f1"))  # four rows, read by both runs
    IO.log_experiment(m.where(F.col("model_name").isin("rule_a", "rule_b")), root, "exp_ab")
    IO.log_experiment(m.where(F.col("model_name").isin("rule_c", "rule_d")), root, "exp_cd")
    return round_doubles(IO.load_experiments(spark, root, "exp_cd"))


@query("model_registry", X.with_sql(X.SCORED_MANY_SQL + _MANY_CTE, """SELECT
  CAST(row_number() OVER (ORDER BY model_name DESC) AS INTEGER) AS position, model_name,
  CAST(row_number() OVER (ORDER BY model_name) AS INTEGER) AS version, round(f1, 6) AS f1 FROM metrics"""))
def q_model_registry(spark, sf):
    """One registry row per saved model (registered in name order), newest first."""
    from pyspark.sql.window import Window

    root = work_dir(spark, "registry")
    m = metrics_many(spark, sf).select("model_name", "f1")
    version = F.row_number().over(Window.orderBy("model_name")).cast("int")  # one row per model
    m.withColumn("version", version).write.mode("append").partitionBy("model_name").parquet(root)
    reg = spark.read.schema("f1 double, version int, model_name string").parquet(root)
    out = reg.withColumn("position", F.row_number().over(Window.orderBy(F.desc("version")))).select(
        F.col("position").cast("int"), "model_name", F.col("version").cast("int"), "f1")
    return round_doubles(out)


@query("sample_n", S(f"SELECT key, type, torque FROM sensor ORDER BY {PR.split_hash_sql(seed=7)}, key LIMIT 1000"))
def q_sample_n(spark, sf):
    """Quick-run sample: the 1000 rows with the smallest key hash (top-n, the limit is the feature)."""
    return IO.sample_n(X.sensor(spark, sf).select("key", "type", "torque"), "key", 1000, seed=7)
