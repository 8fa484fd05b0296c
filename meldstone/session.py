"""Session settings used by the jobs, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "meldstone", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and UTC time.

    On a cluster leave ``master`` unset: partition counts then come from the
    cluster's own configuration and adaptive execution coalesces or splits them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Joins whose partitions turn out small hash them instead of sorting.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
