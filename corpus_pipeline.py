"""Documents to training files: filter, remove near copies, decontaminate, mix, write token ids.

Each stage takes (spark, docs, sf_dir) and returns a table that is stored and read again
before the next; so every stage is a point of recovery. All but the last return the
columns of ``documents``; the mix repeats rows that it takes several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from addrspark.llm import decontamination, jaccard_join, mixing, quality, token_files
from addrspark.llm.tables import table
from addrspark.shared import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no anomalies."""
    return quality.passing(docs, quality.fitted(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return jaccard_join.one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back: one row per document in them."""
    return token_files.token_summary(docs, token_files.default_tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token output", token_output),
]

#: Forest, similarity join, seeds and tokenizer are not expressible in SQL; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
