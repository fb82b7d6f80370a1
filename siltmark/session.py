"""The session that the command-line tools, bench and tests of this package start from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None, app: str = "siltmark") -> SparkSession:
    """On a cluster leave master and partitions unset: the submitted configuration holds, with AQE sizing the shuffles."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", partitions)
    return builder.getOrCreate()
