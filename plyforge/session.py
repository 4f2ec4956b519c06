"""Session factory and the few settings that the engine relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "plyforge", cpus: int | None = None, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
