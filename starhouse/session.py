"""Session settings for the benchmark and the tests, on one machine.

Anything else, the command line included, takes the session as it is configured
and submitted; nothing in the library depends on settings made here.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app_name: str = "starhouse", cores: str | None = None, **conf: str) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "*")
    builder = (
        SparkSession.builder.appName(app_name)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
