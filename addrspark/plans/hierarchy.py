"""Queries up and down the hierarchy: object cards, ancestors, children, subtrees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from addrspark.functions.names import contains_text, indented
from addrspark.functions.paths import below
from addrspark.operators.addresses import SEPARATOR, place_steps
from addrspark.operators.ranking import ascending, listed, numbered
from addrspark.operators.walks import walk_down, walk_up
from addrspark.plans.addresses import limited_to
from addrspark.registry import Registry


def with_level_name(df: DataFrame, reg: Registry) -> DataFrame:
    """Add ``level_name``, NULL for a level the dictionary lacks."""
    return df.join(reg.levels, "level_num", "left")


def address_chain(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """The chain from each object to its root, with the whole address on each row."""
    chain = walk_up(reg, ids)
    whole = Window.partitionBy("start_objectid")
    ordered = F.array_sort(F.collect_list(F.struct("level_num", (-F.col("depth")).alias("rank"), "label")).over(whole))
    labels = F.filter(F.transform(ordered, lambda step: step["label"]), lambda label: label.isNotNull())
    rows = chain.select(
        F.col("start_objectid").alias("target_objectid"),
        "objectid",
        F.col("level_num").alias("level"),
        "typename",
        "name",
        "depth",
        F.when(F.size(labels) > 0, F.array_join(labels, SEPARATOR)).alias("full_address"),
    )
    return listed(rows, ids, "target_objectid", "level", "depth")


def object_card(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """Address objects with level name, path and parent."""
    rows = limited_to(reg.places, ids).join(reg.hierarchy, "objectid")
    return with_level_name(rows, reg).select(
        "objectid", "objectguid", "name", "typename", "level", "level_name", "path", "parentobjid"
    )


def ancestors(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """The known address objects on the path of each object, itself included."""
    rows = limited_to(reg.hierarchy.select("objectid", "path"), ids)
    rows = place_steps(rows.withColumnRenamed("objectid", "target_objectid"), with_level_name(reg.places, reg)).select(
        "target_objectid", "position", F.col("element_id").alias("objectid"), "level", "level_name", "typename", "name",
        F.col("label").alias("display_name"),
    )
    return listed(rows, ids, "target_objectid", "position")


def numbered_children(reg: Registry, level: str = "3", parent: int | None = None) -> DataFrame:
    """Children of one level, numbered by name under each parent (or under one)."""
    hierarchy = reg.hierarchy if parent is None else reg.hierarchy.where(F.col("parentobjid") == parent)
    children = (
        reg.places.where(F.col("level") == level)
        .join(hierarchy, "objectid")
        .select("parentobjid", "objectid", "name", "typename", "path")
    )
    rows = numbered(children, ["parentobjid"], ["name", "objectid", "path"]).select(
        "parentobjid", "num", "objectid", "name", "typename", "path"
    )
    return listed(rows, None if parent is None else [parent], "num")


def numbered_places(reg: Registry, level: str) -> DataFrame:
    """All address objects of one level, numbered by name without any grouping."""
    places = reg.places.where(F.col("level") == level).select("objectid", "name", "typename")
    return numbered(places, [], ["name", "objectid"]).select("num", "objectid", "name", "typename")


def child_by_name(reg: Registry, parent: int, part: str, level: str = "3") -> DataFrame:
    """Children of a parent by level and part of the name."""
    places = reg.places.where((F.col("level") == level) & contains_text("name", part))
    rows = places.join(reg.hierarchy.where(F.col("parentobjid") == parent), "objectid")
    return rows.select("objectid", "name", "typename", "level", "path").orderBy(*ascending("name", "objectid"))


def objects_under(
    reg: Registry, prefix: str | None, min_level: int = 1, max_level: int = 6, strict: bool = False
) -> DataFrame:
    """Address objects of a range of levels under a path prefix (None: anywhere)."""
    hierarchy = reg.hierarchy_under(prefix, strict)
    rows = reg.places.where(F.col("level_num").between(min_level, max_level)).join(hierarchy, "objectid")
    return with_level_name(rows, reg).select(
        "objectid", "level_num", "level_name", "typename", "name", "path", "parentobjid"
    ).orderBy(*ascending("level_num", "path", "objectid"))


def settlements_below(reg: Registry, prefix: str) -> DataFrame:
    """Cities and localities (levels 5 and 6) strictly below a path."""
    rows = reg.places.where(F.col("level_num").isin(5, 6)).join(reg.hierarchy_under(prefix).where(below(prefix)), "objectid")
    return (
        with_level_name(rows, reg)
        .orderBy(*ascending("level_num", "name", "objectid"))
        .select("objectid", "name", "typename", "level", "level_name", "path")
    )


def subtree(
    reg: Registry, roots: DataFrame | list[int] | None, max_level: int | None = None, limit: int | None = None
) -> DataFrame:
    """Names indented by depth, in path order; paths sort as text."""
    rows = walk_down(reg, roots, max_level).orderBy(*ascending("start_objectid", "path", "objectid"))
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(
        F.col("start_objectid").alias("root_objectid"),
        indented("name", "depth").alias("name_indented"),
        "objectid",
        F.col("level_num").alias("level"),
        "typename",
        "depth",
    )
