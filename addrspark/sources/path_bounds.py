"""A small index of the files of a hierarchy table: the least and the greatest path of each.

It is a parquet table in the folder ``_bounds`` of the table, which Spark's readers pass over. It has one row per
file, so it is small beside the table, and its rows for a prefix are few if the table is clustered by path. An index that does not name the files that are
there, as after a load by other means, is not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

FOLDER = "_bounds"


def _name(file: Column) -> Column:
    """A file by its name and the region folder around it, however the table's address is written."""
    return F.regexp_extract(file, "((?:[^/=]+=[^/]*/)*[^/]+)$", 1)


def file_bounds(spark: SparkSession, path: str) -> DataFrame:
    """(file, low, high) of the files of a table; the name is taken out of the address once per file, not once per row."""
    addresses = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("address")).agg(F.min("path").alias("low"), F.max("path").alias("high"))
    return addresses.groupBy(_name(F.col("address")).alias("file")).agg(F.min("low").alias("low"), F.max("high").alias("high"))


def write_bounds(spark: SparkSession, path: str) -> None:
    """Index the files of a table that was just loaded; reads the paths only."""
    file_bounds(spark, path).coalesce(1).write.mode("overwrite").parquet(f"{path}/{FOLDER}")


def read_bounds(spark: SparkSession, path: str, table: DataFrame) -> DataFrame | None:
    """(file, low, high) of the files of ``table``, read from ``path``; None if there is no index of just these files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    if not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return None
    bounds = spark.read.schema("file string, low string, high string").parquet(f"{path}/{FOLDER}")
    there = spark.createDataFrame([(f,) for f in table.inputFiles()], "file string").select(_name(F.col("file")).alias("file"))
    differ = bounds.select("file").exceptAll(there).unionByName(there.exceptAll(bounds.select("file")))
    return bounds if differ.isEmpty() else None


def _may_hold(prefix: str) -> Column:
    """Files with a path that begins with the prefix: their bounds enclose the range of such texts."""
    return (F.col("high") >= prefix) & ((F.col("low") <= prefix) | F.col("low").startswith(prefix))


def read_under(spark: SparkSession, path: str, schema: T.StructType, bounds: DataFrame, prefix: str) -> DataFrame:
    """The files of a table that may hold paths with a prefix; what they hold besides is not filtered out."""
    files = [f"{path}/{row.file}" for row in bounds.where(_may_hold(prefix)).select("file").collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files)
