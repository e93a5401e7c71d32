"""Reading the corpus tables, and what the operators share on Spark's side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def n_words(name: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def utf8_bytes(name: str = "text") -> Column:
    """Bytes of a text in UTF-8; 0 for null."""
    return F.coalesce(F.octet_length(F.col(name)), F.lit(0)).cast("long")
