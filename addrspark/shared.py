"""Tables written to the shared folder of the cluster.

Used where a result must be read more than once and be the same each time: the
levels of a hierarchy walk and the pieces of a distributed numbering. A written
table survives the loss of executors, cuts the lineage and keeps the sizes Spark
needs to choose joins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder, because driver and tasks share one machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="addrspark-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name not used before, below the shared folder."""
    return f"{shared_dir(spark)}/addrspark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back."""
    return materialized(df, label)[0]


def materialized(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``materialize``, with the folder, for tables that can be removed before the result is read."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a written table, wherever the shared folder lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
