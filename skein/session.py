"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "skein", **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; ANSI mode stays on, as Spark sets it."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
