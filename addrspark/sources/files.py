"""The files of a registry folder, as a DataFrame: which tables and regions it has.

A table is one file ``AS_<TABLE>_<digits>….xml`` or ``AS_<TABLE>.xml``, in the
base folder (common tables) or in a folder named by the region's digits. A folder
of part files with such a name counts as one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from addrspark.sources.schemas import COMMON_TABLES, REGION_TABLES

# The path of a table file in the base or in a region's folder, and the
# region's folder in the path of a file or of a part of it. Files elsewhere, as in copies
# of the folder within it, are no table files.
TABLE_FILE = r"(?i)^(?:(\d+)/)?AS_([A-Z_]+?)(?:_\d[^/]*)?\.xml(?=$|/[^/]+$)"
REGION_FOLDER = r"/(\d+)/AS_[^/]+(?:/[^/]+)?$"
XML = "[xX][mM][lL]"


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """One row per table file: ``table``, ``region`` (NULL for common), ``file``, ``bytes``.

    Only names and sizes are listed, no file is opened.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path", "length")
    below = F.substring_index("path", base.rstrip("/") + "/", -1)
    sizes = (
        found.select(F.regexp_extract(below, TABLE_FILE, 0).alias("file"), "length")
        .where("file <> ''")
        .groupBy("file")
        .agg(F.sum("length").alias("bytes"))
    )
    return sizes.select(
        F.upper(F.regexp_extract("file", TABLE_FILE, 2)).alias("table"),
        F.nullif(F.regexp_extract("file", TABLE_FILE, 1), F.lit("")).alias("region"),
        "file",
        "bytes",
    )


def list_regions(files: DataFrame) -> DataFrame:
    """The regions that have files, in order."""
    return files.where("region is not null").select("region").distinct().orderBy("region")


def region_folders(spark: SparkSession, base: str) -> DataFrame:
    """The regions that have a folder directly below the base, also an empty one, in order.

    One folder is listed, by the file system of its address.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    names = [status.getPath().getName() for status in found if status.isDirectory()]
    regions = [(name,) for name in names if name.isascii() and name.isdigit()]
    return spark.createDataFrame(regions, "region string").orderBy("region")


def missing_regions(files: DataFrame, requested: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Requested regions that are not among ``regions``, by default those with files."""
    regions = list_regions(files) if regions is None else regions
    return requested.select("region").distinct().join(regions, "region", "left_anti").orderBy("region")


def selected_regions(files: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested regions that are there, in order."""
    return list_regions(files).join(requested.select("region"), "region", "left_semi").orderBy("region")


def file_problems(files: DataFrame, tables: list[str], regions: DataFrame) -> DataFrame:
    """Expected (table, region) pairs that do not have exactly one file."""
    spark = files.sparkSession
    common = [name for name in tables if name in COMMON_TABLES]
    regional = [name for name in tables if name in REGION_TABLES]
    schema = "table string, region string"
    expected = spark.createDataFrame([(name, None) for name in common], schema).unionByName(
        regions.select(F.explode(F.array(*map(F.lit, regional)).cast("array<string>")).alias("table"), "region")
    )
    found = files.groupBy("table", "region").agg(F.count("*").alias("n")).select(
        F.col("table").alias("_table"), F.col("region").alias("_region"), "n"
    )
    same = (F.col("table") == F.col("_table")) & F.col("region").eqNullSafe(F.col("_region"))
    return (
        expected.join(found, same, "left")
        .select("table", "region", F.coalesce("n", F.lit(0)).alias("n_files"))
        .where("n_files <> 1")
        .orderBy("table", "region")
    )


def table_sizes(files: DataFrame) -> DataFrame:
    """Bytes per table."""
    return files.groupBy(F.lower("table").alias("table_name")).agg(F.sum("bytes").alias("bytes"))


def table_glob(table: str) -> str:
    """Path pattern of a table's file. The digit keeps ``X_PARAMS`` out of ``X``."""
    return f"{{AS_{table},AS_{table}_[0-9]*}}.{XML}"
