"""Session settings for this library's jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "fablens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and skew handling on, and the web page off.

    ``master`` is left to the launcher on a cluster. Shuffle partitions start
    high there and AQE coalesces them; pass a small number for local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
