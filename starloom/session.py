"""Session settings the engine relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs the next join one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stored intermediate results go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Plans are built by many small calls; recording the Python call site of each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "starloom", **conf: str) -> SparkSession:
    """A session with the engine's settings; keyword ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is set and all runs on one machine (tests)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="starloom-")
    sc.setCheckpointDir(local)
    return local


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a result's size, from file sizes and the plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def auto_broadcast_bytes(spark: SparkSession) -> int:
    """The size up to which Spark broadcasts by itself; negative if it never does."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * 1024 ** "bkmgtp".index((unit or "b")[0])


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that it survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
