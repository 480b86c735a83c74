"""Local session shared by tests, bench and tools."""

import os

from pyspark.sql import SparkSession


def make_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("mlframe")
        .config("spark.sql.shuffle.partitions", cpus if cpus != "*" else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
