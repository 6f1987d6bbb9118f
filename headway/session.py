"""The Spark session that the engine's jobs expect."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build(app: str = "headway", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. A cluster's own settings (master, partitions, checkpoints) stay."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("HEADWAY_DRIVER_MEMORY", "8g")).config("spark.ui.enabled", "false")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in (settings | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
