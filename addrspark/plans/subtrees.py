"""Subtrees as ranges: nodes are numbered once so that everything below a node lies between two numbers.

The nodes are put in the order of their trails (the ids from the top down to them). A node's ``entry`` is its place in that order, its ``exit`` the
last place below it. Trails end at pruned nodes (inactive or not actual), so a range holds exactly what a walk down
the parent links reaches. Stored in order of ``entry``: a subtree is one range predicate, which skips files and row groups. A
node keeps the levels on its trail, so a level limit is a filter: a node above it ends a walk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from addrspark.functions.names import indented
from addrspark.operators.ranking import ascending, numbered
from addrspark.operators.walks import NODE_COLUMNS, numbered_nodes, trails
from addrspark.registry import Registry

#: Roots whose ranges are put into one filter.
MOST_ROOTS = 100


class SubtreeIndex:
    """``labels``: the nodes by entry, with exit, row and levels. ``places``: (objectid, row, entry, exit, depth), by objectid."""

    def __init__(self, spark: SparkSession, base: str):
        self.labels, self.places = spark.read.parquet(f"{base}/labels"), spark.read.parquet(f"{base}/places")

    @classmethod
    def build(cls, reg: Registry, base: str) -> SubtreeIndex:
        """Label a registry; to be done after each load. A cycle of parent links is an error."""
        all_nodes = numbered_nodes(reg)
        found = trails(all_nodes)
        if found.cyclic:
            raise ValueError("the parent links of the hierarchy form a cycle")
        key = F.flatten(F.transform("trail", lambda node: F.array(node["objectid"], node["row"])))  # two numbers a step
        rows = numbered(found.table.select(key.alias("key"), F.transform("trail", lambda node: node["level"]).alias("levels")), [], ["key"], "entry")
        # Every node is in the ranges of all nodes on its trail; the first one in a range is its own.
        ranges = rows.select("entry", "levels", "key", F.explode(F.sequence(F.lit(2), F.size("key"), F.lit(2))).alias("n"))
        ranges = ranges.select(F.slice("key", F.lit(1), F.col("n")).alias("key"), "entry", F.when(F.col("n") == F.size("key"), F.col("levels")).alias("levels"))
        ranges = ranges.groupBy("key").agg(F.min("entry").alias("entry"), F.max("entry").alias("exit"), F.max("levels").alias("levels"))
        ranges = ranges.select(F.element_at("key", -1).alias("row"), "entry", "exit", "levels")
        labels = ranges.join(all_nodes, "row").select("entry", "exit", "row", "levels", *NODE_COLUMNS)
        labels.repartitionByRange("entry").sortWithinPartitions("entry").write.parquet(f"{base}/labels")
        spark = labels.sparkSession
        places = spark.read.schema(labels.schema).parquet(f"{base}/labels").select("objectid", "row", "entry", "exit", F.size("levels").alias("depth"))
        places.repartitionByRange("objectid").sortWithinPartitions("objectid").write.parquet(f"{base}/places")
        return cls(spark, base)

    def below(self, roots: list[int], max_level: int | None = None) -> DataFrame:
        """As ``walks.walk_down``: each root (depth 0) and everything below it. At most ``MOST_ROOTS`` roots."""
        if len(roots) > MOST_ROOTS:
            raise ValueError(f"more than {MOST_ROOTS} roots: use walk_down")
        # An object has one row here as a rule, and its ranges are alike if it has several.
        found = self.places.where(F.col("objectid").isin(roots)).groupBy("row").agg(F.min(F.struct("entry", "exit", "depth", "objectid")).alias("r"))
        parts = []
        for entry, end, depth, objectid in sorted(found.select("r.*").collect()):
            rows = self.labels.where(F.col("entry").between(entry, end))
            if max_level is not None:
                under = F.slice("levels", depth + 1, 1 << 30)
                rows = rows.where(~F.exists(under, lambda level: F.coalesce(level > max_level, F.lit(True))))
            parts.append(rows.select(
                F.lit(objectid).cast("bigint").alias("start_objectid"), *NODE_COLUMNS, (F.size("levels") - depth).cast("bigint").alias("depth")))
        if not parts:
            return self.labels.where("false").select(F.col("objectid").alias("start_objectid"), *NODE_COLUMNS, F.lit(0).cast("bigint").alias("depth"))
        return reduce(DataFrame.unionByName, parts)

    def subtree(self, roots: list[int], max_level: int | None = None, limit: int | None = None) -> DataFrame:
        """As ``hierarchy.subtree``: names indented by depth, in path order."""
        rows = self.below(roots, max_level).orderBy(*ascending("start_objectid", "path", "objectid"))
        if limit is not None:
            rows = rows.limit(limit)
        return rows.select(
            F.col("start_objectid").alias("root_objectid"), indented("name", "depth").alias("name_indented"), "objectid",
            F.col("level_num").alias("level"), "typename", "depth")
