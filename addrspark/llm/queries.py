"""The queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from addrspark.llm import (
    chat, decontamination, html_text, jaccard_join, mixing, periodic_runs, prefix_trie, quality, sharding, simhash, span_dedup,
    token_files, toxicity)


ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = Path(tempfile.mkdtemp(prefix="addrspark-")) / "addrspark.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in (*sorted((ROOT / "addrspark").rglob("*.py")), ROOT / "corpus_pipeline.py"):
                out.write(path, path.relative_to(ROOT))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def shipping(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        "op1_jaccard": jaccard_join.op1,
        "op2_html": html_text.op2,
        "op3_toxicity": toxicity.op3,
        "op4_mixing": mixing.op4,
        "op5_sharding": sharding.op5,
        "op6_decontamination": decontamination.op6,
        "op7_quality": quality.op7,
        "op8_span_dedup": span_dedup.op8,
        "op9_token_files": token_files.op9,
        "op10_chat": chat.op10,
        "op11_periodic_runs": periodic_runs.op11,
        "op12_simhash": simhash.op12,
        "op13_prefix_trie": prefix_trie.op13,
        "pipeline": corpus_pipeline.run,
    }
    return {name: shipping(query) for name, query in own.items()}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": mixing.OP4_SQL, "op10_chat": chat.OP10_SQL, "op13_prefix_trie": prefix_trie.OP13_SQL}
