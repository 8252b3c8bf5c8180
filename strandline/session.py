"""Spark session for local runs, tests and the benchmark."""

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session; on a cluster the caller's own session is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strandline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
