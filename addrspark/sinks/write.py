"""Writing tables: as partitioned parquet, or as text in one of four layouts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from addrspark.sinks.render import BATCH_SIZE, DIALECTS, insert_statements, row_lines
from addrspark.sources.path_bounds import write_bounds
from addrspark.sources.schemas import primary_key

# The layouts, by the columns that name the folders.
LAYOUTS = {
    "direct": [],
    "per_region": ["region"],
    "per_table": ["table"],
    "region_tree": ["region", "table"],
}
COMMON = "common"


def check_layout(platform: str, layout: str) -> None:
    """Plain rows carry no table name, so each table needs files of its own."""
    if platform not in DIALECTS:
        raise ValueError(f"unknown platform {platform}: one of {', '.join(DIALECTS)}")
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout}: one of {', '.join(LAYOUTS)}")
    if not DIALECTS[platform].inserts and layout != "region_tree":
        raise ValueError(f"{platform} needs the layout region_tree")


def dump_lines(
    tables: Mapping[str, DataFrame], platform: str, batch_size: int = BATCH_SIZE, keys: Mapping[str, list[str]] = {}
) -> DataFrame:
    """All tables as ``(table, region, line)``.

    Tables without a ``region`` column are common ones. Rows are batched in order of
    ``keys``, else of the primary key, else, if it was not read, of all columns; rows
    that are equal in all columns are alike.
    """
    dialect, lines = DIALECTS[platform], []
    for name, df in tables.items():
        df = df if "region" in df.columns else df.withColumn("region", F.lit(COMMON))
        if dialect.inserts:
            columns = [c for c in df.columns if c != "region"]
            key = primary_key(name)
            order = keys.get(name) or ([key] if key in columns else columns)
            text = insert_statements(df, name, dialect, order, ("region",), batch_size)
            rows = text.select("region", F.rtrim(F.col("statement"), F.lit("\n")).alias("line"))
        else:
            rows = row_lines(df, dialect, ("region",))
        lines.append(rows.select(F.lit(name).alias("table"), F.col("region").cast("string").alias("region"), "line"))
    return reduce(DataFrame.unionByName, lines)


def write_dump(
    tables: Mapping[str, DataFrame], path: str, platform: str, layout: str, batch_size: int = BATCH_SIZE,
    keys: Mapping[str, list[str]] = {},
) -> None:
    """Write the tables as text below ``path``.

    The rows are rebalanced by folder, which merges small pieces and splits a
    large region over several files.
    """
    check_layout(platform, layout)
    folders = LAYOUTS[layout]
    lines = dump_lines(tables, platform, batch_size, keys)
    if folders:
        lines = lines.hint("rebalance", *[F.col(folder) for folder in folders])
    lines.select(*folders, "line").write.partitionBy(*folders).text(path)


def load_table(df: DataFrame, path: str, append: bool = False) -> None:
    """Store a table as parquet, by region if it has one.

    Loading a region again replaces it; ``append`` adds the rows to those already
    there, as the registry's SQL loads do. Hierarchy tables are clustered: dealt out by range of region and
    path, so that a file holds the paths between two bounds and a large region has many files. The bounds of all
    files are kept beside them (``sources.path_bounds``), so that a search by path prefix opens only the files that may hold it.
    """
    by_region = "region" in df.columns
    clustered = "path" in df.columns
    if clustered:
        order = ["region", "path"] if by_region else ["path"]
        rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        rows = df.hint("rebalance", F.col("region")) if by_region else df
    writer = rows.write
    if by_region:
        writer = writer.partitionBy("region")
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    if clustered:
        write_bounds(df.sparkSession, path)


def load_registry(tables: Mapping[str, DataFrame], base: str, append: bool = False) -> None:
    """Store tables as ``<base>/<name>``, one job each."""
    for name, df in tables.items():
        load_table(df, f"{base}/{name}", append)


def load_bucketed(tables: Mapping[str, DataFrame], database: str, buckets: int, base: str | None = None) -> None:
    """Store tables in the catalog, those of objects bucketed and sorted by ``objectid``.

    Joins and groupings by ``objectid`` then need no shuffle. ``buckets`` should
    give a bucket of the largest table some hundred megabytes. A bucket takes its
    share of every region, so a large region does not make a large bucket.
    """
    for name, df in tables.items():
        if "objectid" in df.columns:
            writer = df.repartition(buckets, "objectid").write.bucketBy(buckets, "objectid").sortBy("objectid")
        else:
            writer = df.write
        if base is not None:
            writer = writer.option("path", f"{base}/{name}")
        writer.mode("overwrite").saveAsTable(f"{database}.{name}")
