"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale; a cluster's own settings win where present.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Wide projections (50+ feature columns) generate one huge method; above 8000
    # bytes of bytecode the JVM does not JIT it.  Falling back to split
    # per-expression code for such stages is several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "vigil", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  ``master`` is only set for local runs."""
    from pyspark import SparkConf

    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    preset = SparkConf()  # spark-defaults / submit options of the cluster
    for k, v in _DEFAULTS.items():
        if not preset.contains(k):
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  Only a local-mode session without one gets a private
    temporary folder, which is then also installed as its checkpoint dir.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="vigil-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}") if "://" not in base else f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    return path
