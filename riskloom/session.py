"""Session settings and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "riskloom", **conf: str) -> SparkSession:
    """Session with UTC times, adaptive execution (coalescing and skew splitting) and stream
    state on disk."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ensure_shared_folder(spark: SparkSession) -> None:
    """Checkpoint folder: the one the cluster names in `spark.checkpoint.dir`, a folder that driver
    and executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(named)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared folder, in a folder of the application that is removed when its
    JVM ends."""
    ensure_shared_folder(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    own = "/".join([base.rstrip("/"), "riskloom", spark.sparkContext.applicationId])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    return "/".join([own, *parts, uuid.uuid4().hex])
