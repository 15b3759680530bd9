"""Session defaults for jobs that use this library."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Left to the cluster: executor counts, memory, spark.checkpoint.dir. A high
# shuffle partition count is safe because adaptive execution merges small ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "feedmill", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    named = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**DEFAULTS, **named}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
