"""Spark session used by the command line, the tests and the benchmark."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def create_session(app_name: str = "matchlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps and adaptive execution.

    Sizing (memory, shuffle partitions, broadcast threshold) belongs to the
    cluster's own configuration; ``conf`` takes overrides, with ``__`` read as a dot.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**SESSION_CONF, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, removed when this process ends.

    It lies below ``spark.checkpoint.dir`` or, where that is unset, in the warehouse,
    which all executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    atexit.register(remove_folder, spark, folder)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the session's file systems, if it is there."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration() if spark._jsc.sc() else None
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(hadoop or jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
