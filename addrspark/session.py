"""A session with the settings the package expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def builder(app_name: str = "addrspark") -> SparkSession.Builder:
    """Builder with adaptive execution on.

    Nothing here is needed for right results. Adaptive execution splits hot join
    keys (one region or one street may hold a large share of all rows), merges
    small shuffle partitions, and turns a join into a broadcast one only after it
    has measured the side.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
