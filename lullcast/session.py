"""Session settings for runs this package starts itself (tests and bench)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session; on a cluster, pass your own session to the operators."""
    partitions = 8 if cores == "*" else max(int(cores), 1)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
