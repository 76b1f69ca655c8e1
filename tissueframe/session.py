"""Session settings the library is tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tissueframe", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution; cluster settings come from the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
