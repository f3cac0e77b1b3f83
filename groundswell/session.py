"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A side is broadcast only after its shuffle has measured it.  The planner's own estimate
# does not count the rows that runs, tiles and polygons explode into, so it is not used.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session (all can change at run time)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
