"""Session set-up."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "docloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the engine expects.

    ``master`` is given only for local runs; on a cluster the submit command decides.
    Keyword arguments use ``__`` for the dots of a setting name.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    settings = dict(SETTINGS)
    settings.update({key.replace("__", "."): value for key, value in extra.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
