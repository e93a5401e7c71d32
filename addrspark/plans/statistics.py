"""Counts of objects by level and place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from addrspark.functions.paths import root_id
from addrspark.operators.ranking import ascending
from addrspark.registry import Registry

# How houses appear among the levels.
HOUSE_LEVEL = 10
HOUSE_LEVEL_NAME = "Здание (дом)"


def named_levels(counts: DataFrame, reg: Registry, keys: list[str], sums: list[str]) -> DataFrame:
    """Add the level name to counts per level.

    The dictionary is joined after counting, to a few rows. Summing again keeps
    the result right for a dictionary with repeated levels.
    """
    named = counts.join(reg.levels, "level_num", "left")
    return named.groupBy(*keys, "level_num", "level_name").agg(*[F.sum(c).alias(c) for c in sums])


def counts_by_level(reg: Registry) -> DataFrame:
    """All, actual and active address objects per level."""
    counts = (
        reg.table("addr_obj")
        .groupBy(F.col("level").cast("bigint").alias("level_num"))
        .agg(
            F.count("*").alias("total_objects"),
            F.count_if(F.col("isactual") == 1).alias("actual_objects"),
            F.count_if(F.col("isactive") == 1).alias("active_objects"),
        )
    )
    sums = ["total_objects", "actual_objects", "active_objects"]
    named = named_levels(counts, reg, [], sums)
    return named.select(F.col("level_num").alias("level"), "level_name", *sums).orderBy(*ascending("level"))


def _placed(reg: Registry, prefix: str | None, strict: bool, max_level: int | None) -> DataFrame:
    hierarchy = reg.hierarchy_under(prefix, strict)
    places = reg.places if max_level is None else reg.places.where(F.col("level_num") <= max_level)
    return places.join(hierarchy, "objectid")


def level_counts(
    reg: Registry, prefix: str | None = None, max_level: int | None = None, strict: bool = False
) -> DataFrame:
    """Address objects per level under a path prefix (None: anywhere)."""
    counts = _placed(reg, prefix, strict, max_level).groupBy("level_num").agg(F.count("*").alias("object_count"))
    return named_levels(counts, reg, [], ["object_count"]).orderBy(*ascending("level_num"))


def level_counts_by_root(reg: Registry, max_level: int | None = None) -> DataFrame:
    """Address objects per root of the hierarchy and level, for all roots at once."""
    rows = _placed(reg, None, False, max_level)
    counts = rows.groupBy(root_id().alias("root_objectid"), "level_num").agg(F.count("*").alias("object_count"))
    return named_levels(counts, reg, ["root_objectid"], ["object_count"]).orderBy(*ascending("root_objectid", "level_num"))


def _housed(reg: Registry, prefix: str | None, strict: bool) -> DataFrame:
    hierarchy = reg.hierarchy_under(prefix, strict)
    return reg.houses.select("objectid").join(hierarchy.select("objectid", "path"), "objectid")


def house_count(reg: Registry, prefix: str | None = None, strict: bool = False) -> DataFrame:
    """Actual houses under a path prefix (None: anywhere)."""
    return _housed(reg, prefix, strict).agg(F.count("*").alias("houses_count"))


def house_counts_by_root(reg: Registry) -> DataFrame:
    """Actual houses per root of the hierarchy."""
    return _housed(reg, None, False).groupBy(root_id().alias("root_objectid")).agg(F.count("*").alias("houses_count"))


def full_statistics(reg: Registry, prefix: str | None = None, strict: bool = False) -> DataFrame:
    """Address objects per level, and the houses as one more level."""
    objects = level_counts(reg, prefix, strict=strict).select(
        F.lit("addr_obj").alias("source_table"), "level_num", "level_name", F.col("object_count").alias("count")
    )
    houses = house_count(reg, prefix, strict).select(
        F.lit("houses").alias("source_table"),
        F.lit(HOUSE_LEVEL).cast("bigint").alias("level_num"),
        F.lit(HOUSE_LEVEL_NAME).alias("level_name"),
        F.col("houses_count").alias("count"),
    )
    return objects.unionByName(houses).orderBy(*ascending("level_num", "source_table"))
