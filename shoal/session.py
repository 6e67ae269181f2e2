"""Session helpers: a configured local session for tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

UTC_CONF = ("spark.sql.session.timeZone", "UTC")


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "shoal", extra: dict | None = None) -> SparkSession:
    """Session used by tests and ``bench.py``; on a cluster use the cluster's own."""
    master = master or os.environ.get("SHOAL_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config(*UTC_CONF)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("SHOAL_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are UTC text, so every time computation needs a UTC session.
    NOTE: this sets the zone of the caller's session; queries that run
    afterwards in it see UTC too. Callers that need another zone use
    ``spark.newSession()``."""
    if spark.conf.get(UTC_CONF[0], None) != "UTC":
        spark.conf.set(*UTC_CONF)
