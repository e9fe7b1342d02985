"""The local session of the tests and of the comparison tool."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("TEST_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("newslake")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
