"""Sources and sinks.

Reads always take an explicit schema (no inference pass over the data);
directory reads take every file and carry the file name through
``_metadata``; writes go to the session's shared work folder and are
partitioned by the columns later reads filter on, so those reads prune.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.roles import RAW_TO_ROLE

# Raw sensor CSV schema (display names), FIXTURES.md 1a.
RAW_SCHEMA = T.StructType([
    T.StructField("UDI", T.LongType()), T.StructField("Product ID", T.StringType()), T.StructField("Type", T.StringType()),
    T.StructField("Air temperature [K]", T.DoubleType()), T.StructField("Process temperature [K]", T.DoubleType()),
    T.StructField("Rotational speed [rpm]", T.DoubleType()), T.StructField("Torque [Nm]", T.DoubleType()),
    T.StructField("Tool wear [min]", T.DoubleType()), T.StructField("Machine failure", T.IntegerType()),
    T.StructField("TWF", T.IntegerType()), T.StructField("HDF", T.IntegerType()), T.StructField("PWF", T.IntegerType()),
    T.StructField("OSF", T.IntegerType()), T.StructField("RNF", T.IntegerType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("prediction", T.IntegerType()), T.StructField("probability", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("risk_level", T.StringType()),
    T.StructField("recommended_action", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("timestamp", T.StringType()), T.StructField("input_features", T.MapType(T.StringType(), T.DoubleType())),
])


class EmptyInput(ValueError):
    pass


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, to_roles: bool = True) -> DataFrame:
    """Header CSV with an explicit schema; an absent or empty input raises."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    if df.isEmpty():
        raise EmptyInput(f"no rows in {path}")
    return df.withColumnsRenamed({k: v for k, v in RAW_TO_ROLE.items() if k in df.columns}) if to_roles else df


def scan_dir(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, fmt: str = "csv") -> DataFrame:
    """Every file under a directory (not only the first), with its file path."""
    r = spark.read.schema(schema).option("recursiveFileLookup", True)
    if fmt == "csv":
        r = r.option("header", True)
    df = r.format(fmt).load(path)
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def scan_predictions(spark: SparkSession, path: str, schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    """S3: prediction JSON files; the parent folder name becomes ``source``."""
    df = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    return df.withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1))


SUFFIX_FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet", ".jsonl": "json"}


def scan_any(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None) -> DataFrame:
    """Format from the argument or the path suffix (default csv)."""
    fmt = fmt or SUFFIX_FORMATS.get(os.path.splitext(path.rstrip("/"))[1].lower(), "csv")
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    return r.format(fmt).load(path)


SENSOR_FIELDS = ["air_temp", "proc_temp", "speed", "torque", "wear"]


def parse_readings(lines: DataFrame, col: str = "value") -> DataFrame:
    """Comma-separated reading lines.  Five fields -> the named sensors;
    other lengths -> all values, in order, in the array ``features`` (element i
    is feature_i); a field that is not a number -> NULL and the line is kept in
    ``_corrupt``."""
    parts = F.split(F.trim(F.col(col)), ",")
    n = F.size(parts)
    vals = F.transform(parts, lambda s: F.trim(s).try_cast("double"))
    named = {f: F.when(n == 5, vals[i]) for i, f in enumerate(SENSOR_FIELDS)}
    bad = F.exists(vals, lambda v: v.isNull())
    return lines.withColumns({**named, "features": F.when(n != 5, vals), "n_fields": n, "_corrupt": F.when(bad, F.col(col))})


def sink_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
               mode: str = "overwrite") -> str:
    """Write (parents created by the writer); CSV gets a header."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def save_feature_set(features: DataFrame, name: str, root: str, metadata: DataFrame | None = None,
                     quality: DataFrame | None = None) -> None:
    """Features, metadata and quality written together, each partitioned by ``feature_set``."""
    features.withColumn("feature_set", F.lit(name)).write.mode("append").partitionBy("feature_set").parquet(f"{root}/features")
    if metadata is not None:
        metadata.withColumn("feature_set", F.lit(name)).write.mode("append").partitionBy("feature_set").parquet(f"{root}/metadata")
    if quality is not None:
        quality.withColumn("feature_set", F.lit(name)).write.mode("append").partitionBy("feature_set").parquet(f"{root}/quality")


def load_feature_set(spark: SparkSession, name: str, root: str, with_metadata: bool = False):
    """One set back (only its partition is listed and read, with that set's
    own schema); a missing set raises, metadata is optional."""
    try:
        df = spark.read.option("basePath", f"{root}/features").parquet(f"{root}/features/feature_set={name}")
    except Exception as e:  # noqa: BLE001
        raise KeyError(f"feature set {name!r} not found") from e
    if not with_metadata:
        return df.drop("feature_set")
    try:
        meta = spark.read.option("basePath", f"{root}/metadata").parquet(f"{root}/metadata/feature_set={name}")
    except Exception:  # noqa: BLE001 - metadata is optional
        meta = None
    return df.drop("feature_set"), meta


def sink_predictions(scored: DataFrame, path: str, fmt: str = "json") -> str:
    """Json / csv / text; text lines are the business messages."""
    if fmt == "text":
        scored.select(F.col("message").alias("value")).write.mode("overwrite").text(path)
    elif fmt == "csv":
        scored.write.mode("overwrite").option("header", True).csv(path)
    else:
        scored.write.mode("overwrite").json(path)
    return path


def log_experiment(metrics: DataFrame, root: str, experiment_id: str) -> None:
    """Append a run's metric rows, partitioned by experiment id."""
    metrics.withColumn("experiment_id", F.lit(experiment_id)).write.mode("append").partitionBy("experiment_id").parquet(root)


def load_experiments(spark: SparkSession, root: str, experiment_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(root)
    return df.where(F.col("experiment_id") == experiment_id) if experiment_id else df


def sample_n(df: DataFrame, key: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """The n rows with the smallest key hash (deterministic; top-n, no full sort)."""
    from vigil.operators.prep import split_hash

    return df.withColumn("_h", split_hash(F.col(key), seed)).orderBy("_h", key).limit(n).drop("_h")
