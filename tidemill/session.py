"""A local session for tests and benchmarks; on a cluster, bring your own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = 8, memory: str = "8g", app: str = "tidemill", **settings: str
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def isolated(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session on the same context and catalog, with the same settings plus these.

    Changing settings on the caller's session would reach every query that is
    being planned at the same time, from this thread or another.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(key, value)
    return session
