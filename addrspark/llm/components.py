"""Connected components of a table of links, by large-star and small-star rounds.

Every round ties each node to the smallest node that it can see. Rounds are grouped
minimums and joins; nothing but a count and a checksum reaches the driver, and every
round is a stored table, so a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from addrspark.operators.joins import join_splitting
from addrspark.shared import materialize


def _tied(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with ``low``, the least of u and all its v. A hub's pairs may be split among tasks."""
    least = pairs.groupBy("u").agg(F.min("v").alias("low"))
    return join_splitting(pairs, least, "u").withColumn("low", F.least("u", "low"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of ``links`` (u, v), the smallest node that links reach."""
    links = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _tied(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        small = _tied(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        ends = F.explode(F.array("u", "v")).alias("end")
        links = small.select("low", ends).where("end <> low").select(F.col("end").alias("u"), F.col("low").alias("v")).distinct()
        links = materialize(links, "links")
        if (now := _state(links)) == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
