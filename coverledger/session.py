"""Session settings for large runs. All are runtime SQL settings; a value set by the
user is kept."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Only possible when a session is built: recording the Python call site of every column
# costs more than planning a small query.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that are still at Spark's default."""
    from_user = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in SETTINGS.items():
        if key not in from_user:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Shared folder for checkpoints and stream state, as the cluster names it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if default is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return default
