"""Session factory and table loader shared by queries, tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "fluvial", cores: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with adaptive execution on and UTC time; a cluster's own settings win when submitted there."""
    cores = cores or os.environ.get("BENCH_CPUS", "*")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FLUVIAL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read lazily: filters and column pruning reach the Parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
