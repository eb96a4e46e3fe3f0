"""Session settings that the engine relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(cores: int | None = None, app: str = "spokenlake") -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own session."""
    cores = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
