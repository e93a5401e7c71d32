"""Checks of loaded tables. Each gives a small DataFrame, computed in one pass."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from addrspark.operators.ranking import ascending
from addrspark.registry import Registry
from addrspark.sources.schemas import primary_key

# The tables counted as address objects, and the main ones of them.
OBJECT_TABLES = ["addr_obj", "houses", "apartments", "steads", "rooms"]
MAIN_TABLES = ["addr_obj", "houses", "steads"]


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the declared types; a value that does not fit is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def boolean_number(column: Column | str) -> Column:
    """``true`` / ``false`` as 1 / 0. For columns declared boolean."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column == "true", 1).when(column == "false", 0)


def _per_column(df: DataFrame, counts: dict[str, Column], name: str) -> DataFrame:
    """One row per column with its count; the aggregate is a single row before."""
    if not counts:
        return df.sparkSession.createDataFrame([], f"column_name string, {name} bigint")
    row = df.agg(*[F.count_if(condition).alias(c) for c, condition in counts.items()])
    return row.unpivot([], list(counts), "column_name", name)


def unparsed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, the number of values that do not fit the declared type."""
    bad = {
        f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    }
    return _per_column(df, bad, "unparsed")


def missing_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per required column other than texts, the number of missing values."""
    return _per_column(df, {f.name: F.col(f.name).isNull() for f in schema.fields if not f.nullable}, "missing")


def too_long(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per limited text column, the number of values over the limit."""
    limits = {f.name: f.metadata["max_length"] for f in schema.fields if "max_length" in f.metadata}
    return _per_column(df, {c: F.length(c) > limit for c, limit in limits.items()}, "too_long")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(F.col(key).cast("bigint").alias("key")).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table, values of its primary key that occur more than once."""
    found = [duplicate_keys(df, primary_key(name)).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, found)


def duplicate_objects(df: DataFrame, limit: int = 10) -> DataFrame:
    """The first objects that occur more than once, as after loading a region twice."""
    counts = df.groupBy("objectid").agg(F.count("*").alias("copies")).where("copies > 1")
    return counts.orderBy("objectid").limit(limit)


def row_counts(reg: Registry, tables: list[str]) -> DataFrame:
    """Rows per table."""
    counts = [
        reg.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def object_counts(reg: Registry) -> DataFrame:
    """Rows of the five object tables."""
    return row_counts(reg, OBJECT_TABLES)


def object_totals(reg: Registry) -> DataFrame:
    """All address objects, and the main ones."""
    main = F.when(F.col("table_name").isin(MAIN_TABLES), F.col("row_count")).otherwise(0)
    return object_counts(reg).agg(F.sum("row_count").alias("total_objects"), F.sum(main).alias("main_objects"))


def missing_names(reg: Registry) -> DataFrame:
    """Normative documents: all, those without a name, and their share in percent."""
    counts = reg.table("normative_docs").agg(
        F.count("*").alias("total"), (F.count("*") - F.count("name")).alias("null_count")
    )
    share = F.round(F.lit(100.0) * F.col("null_count") / F.nullif(F.col("total"), F.lit(0)), 1)
    return counts.withColumn("null_percent", share)


def largest_tables(reg: Registry, limit: int = 20, sizes: DataFrame | None = None) -> DataFrame:
    """Tables by rows, the largest first; with bytes if ``sizes`` (name, bytes) are given."""
    counts = row_counts(reg, sorted(reg.tables))
    if sizes is not None:
        counts = counts.join(sizes, "table_name", "left")
    return counts.orderBy(F.col("row_count").desc(), *ascending("table_name")).limit(limit)


def check_expected(reg: Registry, expected: int, tolerance: float = 0.1) -> DataFrame:
    """Whether the main objects are as many as expected, within the tolerance.

    An expected number of zero gives no verdict (NULL).
    """
    deviation = F.lit(100.0) * F.abs(F.col("main_objects") - expected) / F.nullif(F.lit(expected), F.lit(0))
    return object_totals(reg).select(
        "main_objects",
        F.lit(expected).cast("bigint").alias("expected"),
        F.round(deviation, 1).alias("difference_percent"),
        (deviation <= tolerance * 100).alias("passed"),
    )
