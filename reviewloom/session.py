"""A session for tests, benchmarks and the command line."""

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", name: str = "reviewloom", **conf) -> SparkSession:
    """A local session. On a cluster the launcher sets master, memory and shuffle partitions."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
