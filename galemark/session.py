"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, also where that costs an extra exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Window state of a stream may outgrow the heap, so it lives in RocksDB.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "galemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Make a session built elsewhere read and write times in UTC and split hot join keys."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by `spark.checkpoint.dir`; `fallback` only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return root.rstrip("/")
