"""The result of a check of stored tables, kept beside them and bound to the files that were checked.

The mark is one row in the folder ``_verified`` of the registry. It holds a digest of the names and sizes of the
files; a load, also one that adds rows, makes files of new names, so the mark of other files says nothing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

FOLDER = "_verified"
SCHEMA = "files string, single_rows boolean"


def _files(spark: SparkSession, base: str, names: list[str]) -> list[str]:
    """Table, name below the table's folder and size of each file, in order. Folders are listed, no file is opened."""
    found = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
        system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        root, listed = system.makeQualified(path).toString(), system.listFiles(path, True)
        while listed.hasNext():
            status = listed.next()
            below = status.getPath().toString()[len(root) + 1:]
            if not any(part.startswith(("_", ".")) for part in below.split("/")):
                found.append(f"{name}/{below} {status.getLen()}")
    return sorted(found)


def files_digest(spark: SparkSession, base: str, names: list[str]) -> str:
    text = "\n".join(_files(spark, base, names))
    return spark.range(1).select(F.sha2(F.lit(text), 256)).collect()[0][0]


def write_mark(spark: SparkSession, base: str, digest: str, single_rows: bool) -> None:
    """Keep the result of a check of the files of ``digest``, which was taken before the check."""
    mark = spark.createDataFrame([(digest, single_rows)], SCHEMA)
    mark.coalesce(1).write.mode("overwrite").parquet(f"{base}/{FOLDER}")


def read_mark(spark: SparkSession, base: str, names: list[str]) -> bool:
    """Whether a check of just the files that are there found no repeated rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{FOLDER}")
    if not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return False
    rows = spark.read.schema(SCHEMA).parquet(f"{base}/{FOLDER}").where("single_rows").collect()
    return bool(rows) and rows[0]["files"] == files_digest(spark, base, names)
