"""Session settings the plans in this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A routed write has two output directories per task; with concurrent
    # writers Spark does not sort every task's rows by the route first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Observed counts are read from the progress of every micro-batch of a run.
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
}


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benches. On a cluster, pass RECOMMENDED_CONF to spark-submit."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **(extra or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
