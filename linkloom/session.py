"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "linkloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings these jobs count on; ``conf`` adds to them or replaces them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Lets one task write both tables of a crawl without sorting its rows first.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
