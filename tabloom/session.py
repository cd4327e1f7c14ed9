"""Session helper used by the bench, the tests and the tools."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session. On a cluster, pass your own session to the operators instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
