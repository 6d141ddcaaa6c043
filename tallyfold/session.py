"""Session settings and the shared scratch folder used for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set only where the deployment has not chosen a value itself.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Do not record a Python call site for every Column: it doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tallyfold", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    A machine-local folder is chosen only where nothing is configured and everything runs in
    this process; a cluster must name a folder that all its machines see.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by driver and executors")
    local = tempfile.mkdtemp(prefix="tallyfold-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read back: evaluated once, and its lineage is cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tallyfold/{name}-{uuid.uuid4().hex}"
