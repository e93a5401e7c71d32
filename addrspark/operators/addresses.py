"""Address texts built once per distinct place, then joined to many objects.

Thousands of objects share one street. So each object gets a ``bundle`` naming
the path(s) its address is read from; only the distinct bundles are taken apart,
joined to the address objects and put together; the result goes back by one join.
A hot street or region then costs one bundle. Only in the last join does such a key
hold many rows, and that join can be split (see ``operators.joins``).

A bundle is a text: one or more paths, or one or more parent ids, in order, with
a blank between them. More than one appears only if an object has several active
hierarchy rows; the address then holds the parts of all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from addrspark.functions.paths import last_step, parent_path, path_ids
from addrspark.operators.joins import join_splitting

SEPARATOR = ", "
# The levels that get columns of their own in the wide tables.
WIDE_LEVELS = [1, 3, 5, 6, 7, 8]
#: Steps between an object's parent and its nearest place that are taken off: apartment and house of a room.
STEPS_BELOW = 2
LEVEL_ATTRIBUTES = ["objectid", "objectguid", "typename", "name"]


def address_key(df: DataFrame, places: DataFrame) -> DataFrame:
    """Add ``key_path``: the path without the object's own step, if that adds nothing.

    The own step is kept when the object is itself an address object, or when
    the last step is not the object's id. The join is on ``objectid``, by which
    ``df`` is already partitioned.
    """
    known = places.select("objectid").distinct().withColumn("is_place", F.lit(True))
    own_step_only = F.col("is_place").isNull() & (last_step("path") == F.col("objectid").cast("string"))
    return (
        df.join(known, "objectid", "left")
        .withColumn("key_path", F.when(own_step_only, parent_path("path")).otherwise(F.col("path")))
        .drop("is_place")
    )


def bundle_of(column: str) -> Column:
    """Aggregate: the values of a group as one ordered text."""
    return F.array_join(F.array_sort(F.collect_list(F.col(column).cast("string"))), " ").alias("bundle")


def bundled(df: DataFrame, keys: list[str], column: str, single_rows: bool) -> DataFrame:
    """The bundle of ``column`` for each object with the given columns."""
    if single_rows:
        return df.select(*keys, F.coalesce(F.col(column).cast("string"), F.lit("")).alias("bundle"))
    return df.groupBy(*keys).agg(bundle_of(column))


def paths_of_bundles(rows: DataFrame) -> DataFrame:
    """``(bundle, path)`` for the distinct bundles of paths in ``rows``."""
    return rows.select("bundle").distinct().select("bundle", F.explode(F.split("bundle", " ")).alias("path"))


def paths_of_parents(rows: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """``(bundle, path)`` for bundles of parent ids: the active paths of each parent."""
    parents = (
        rows.select("bundle")
        .distinct()
        .select("bundle", F.explode(F.split("bundle", " ")).alias("parent"))
        .where("parent <> ''")
        .select("bundle", F.col("parent").cast("bigint").alias("objectid"))
    )
    return parents.join(hierarchy.select("objectid", "path"), "objectid").select("bundle", "path")


def path_steps(df: DataFrame) -> DataFrame:
    """One row per step of ``path``: ``position`` from 1 and ``element_id``."""
    exploded = df.select("*", F.posexplode(path_ids("path")).alias("pos", "element_id"))
    return exploded.withColumn("position", (F.col("pos") + 1).cast("bigint")).drop("pos")


def place_steps(paths: DataFrame, places: DataFrame) -> DataFrame:
    """Steps of ``path`` that are actual address objects, with their attributes."""
    return path_steps(paths).join(places.withColumnRenamed("objectid", "element_id"), "element_id")


def parts_aggregate(single_path: bool = False, name: str = "parts") -> Column:
    """Aggregate: labels of a group in path order; missing labels are left out.

    ``single_path`` says that a group has steps of one path only.
    """
    keys = ["position", "label"] if single_path else ["position", "path", "label"]
    ordered = F.array_sort(F.collect_list(F.struct(*keys)))
    labels = F.transform(ordered, lambda step: step["label"])
    return F.filter(labels, lambda label: label.isNotNull()).alias(name)


def level_aggregates() -> list[Column]:
    """Aggregates: per level and attribute the greatest value, as one column each."""
    columns = {"objectid": "element_id", "objectguid": "objectguid", "typename": "typename", "name": "name"}
    return [
        F.max(F.when(F.col("level_num") == level, F.col(columns[attribute]))).alias(f"level_{level}_{attribute}")
        for level in WIDE_LEVELS
        for attribute in LEVEL_ATTRIBUTES
    ]


def bundle_parts(
    paths: DataFrame, places: DataFrame, wide: bool = False, single_path: bool = False
) -> DataFrame:
    """``parts`` per bundle, with the level columns if ``wide``.

    Bundles without any known address object do not appear.
    """
    extra = level_aggregates() if wide else []
    return place_steps(paths, places).groupBy("bundle").agg(parts_aggregate(single_path), *extra)


def place_paths(paths: DataFrame, places: DataFrame) -> DataFrame:
    """``(bundle, path, place_path)``: each path without the steps below its nearest place.

    Rooms of an apartment, apartments of a house and houses of a street then meet in one path. Each round
    takes off a last step that is no place; the steps left out add nothing to an address.
    """
    known = places.select(F.col("objectid").alias("_last"), F.lit(True).alias("_place")).distinct()
    rows = paths.withColumn("place_path", F.col("path"))
    for _ in range(STEPS_BELOW):
        # Many paths end in one house or street: such a step is split.
        joined_rows = join_splitting(rows.withColumn("_last", last_step("place_path").try_cast("bigint")), known, "_last", "left")
        below = F.col("_place").isNull() & F.col("place_path").contains(".")
        rows = joined_rows.withColumn("place_path", F.when(below, parent_path("place_path")).otherwise(F.col("place_path")))
        rows = rows.drop("_place", "_last")
    return rows


def nearest_parts(paths: DataFrame, places: DataFrame) -> DataFrame:
    """``parts`` per bundle as of ``bundle_parts``; bundles of one path are taken apart once per nearest place."""
    single = place_paths(paths.where("bundle = path"), places).select("bundle", "place_path")
    once = single.select(F.col("place_path").alias("bundle"), F.col("place_path").alias("path")).distinct()
    parts = bundle_parts(once, places, single_path=True).withColumnRenamed("bundle", "place_path")
    several = bundle_parts(paths.where("bundle <> path"), places)
    return single.join(parts, "place_path").select("bundle", "parts").unionByName(several)


def joined(parts: Column | str = "parts", copies: Column | None = None) -> Column:
    """The parts as text, each repeated ``copies`` times; NULL without parts."""
    parts = F.col(parts) if isinstance(parts, str) else parts
    if copies is not None:
        repeated = F.flatten(F.transform(parts, lambda part: F.array_repeat(part, copies.cast("int"))))
        parts = F.when(copies == 1, parts).otherwise(repeated)
    return F.when(F.size(parts) > 0, F.array_join(parts, SEPARATOR))
