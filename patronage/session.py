"""Session settings used by tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "patronage", cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (SparkSession.builder.master(f"local[{cpus}]").appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .getOrCreate())
