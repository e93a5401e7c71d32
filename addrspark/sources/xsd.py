"""Table schemas from the registry's schema documents (XSD).

A schema document is small metadata: a few attributes per table. It is read with
Spark's XML source like any other file of the registry, and gives the columns of a
table in document order and the element of its rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Row, SparkSession, functions as F, types as T

from addrspark.sources.schemas import declared_field

RESTRICTION = "struct<_base: string, `xs:totalDigits`: struct<_value: int>, `xs:maxLength`: struct<_value: int>, " \
    "`xs:length`: struct<_value: int>>"
ATTRIBUTE = "_name string, _type string, _use string, " \
    f"`xs:simpleType` struct<`xs:restriction`: {RESTRICTION}>"
SEQUENCE = "`xs:element` array<struct<_name: string, _ref: string>>"
# Names of schema documents; a folder of part files counts as one.
SCHEMA_GLOB = "[aA][sS]_*.[xX][sS][dD]"
SCHEMA_FILE = r"(?i)/AS_([A-Z_]+?)(?:_\d[^/]*)?\.xsd(?:/[^/]+)?$"


def _plain(type_name: str | None) -> str | None:
    return None if type_name is None else type_name.rpartition(":")[2]


def _field(row: Row) -> T.StructField:
    return declared_field(
        row["name"], _plain(row["type"]), _plain(row["base"]), row["digits"], row["length"], row["use"] == "required"
    )


def _entity(path: str) -> str | None:
    found = re.search(SCHEMA_FILE, path)
    return found and found.group(1).upper()


def _read(spark: SparkSession, paths: str) -> tuple[dict[str, T.StructType], dict[str, str]]:
    """Schemas and row elements by entity, from all documents at once: two jobs, however many there are."""
    restriction, file = "`xs:simpleType`.`xs:restriction`", F.col("_metadata.file_path").alias("file")
    attributes = spark.read.format("xml").option("rowTag", "xs:attribute").schema(ATTRIBUTE).load(paths)
    fields = attributes.select(
        file,
        F.col("_name").alias("name"),
        F.col("_type").alias("type"),
        F.col("_use").alias("use"),
        F.col(f"{restriction}._base").alias("base"),
        F.col(f"{restriction}.`xs:totalDigits`._value").alias("digits"),
        F.coalesce(f"{restriction}.`xs:maxLength`._value", f"{restriction}.`xs:length`._value").alias("length"),
        F.monotonically_increasing_id().alias("position"),
    ).orderBy("position")
    sequences = spark.read.format("xml").option("rowTag", "xs:sequence").schema(SEQUENCE).load(paths)
    elements = sequences.select(file, "xs:element", F.monotonically_increasing_id().alias("position"))
    first = F.expr("get(`xs:element`, 0)")
    tags, files, columns = {}, {}, {}
    for row in elements.select("file", F.coalesce(first["_name"], first["_ref"]).alias("tag")).orderBy("position").collect():
        entity = _entity(row["file"])
        if files.setdefault(entity, row["file"]) != row["file"]:
            raise ValueError(f"several schema documents for {entity}: {files[entity]}, {row['file']}")
        tags.setdefault(entity, row["tag"])
    for row in fields.collect():
        columns.setdefault(_entity(row["file"]), []).append(_field(row))
    without = sorted(entity for entity in columns if not tags.get(entity))
    if without:
        raise ValueError(f"no row element in the schema document of {', '.join(without)}")
    return {entity: T.StructType(found) for entity, found in columns.items()}, {entity: tags[entity] for entity in columns}


def find_schemas(spark: SparkSession, base: str) -> tuple[dict[str, T.StructType], dict[str, str]]:
    """Schemas and row elements by entity, from all ``AS_<ENTITY>….xsd`` documents in a folder; none is no error."""
    paths = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{SCHEMA_GLOB}")
    there = paths.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(paths)
    return _read(spark, f"{base}/{SCHEMA_GLOB}") if there else ({}, {})


def read_schemas(spark: SparkSession, base: str, entities: list[str]) -> tuple[dict[str, T.StructType], dict[str, str]]:
    """Schemas and row elements of the given entities, each of which must have a document in the folder."""
    schemas, row_tags = find_schemas(spark, base)
    missing = [entity for entity in entities if entity not in schemas]
    if missing:
        raise FileNotFoundError(f"no schema document for {', '.join(missing)} in {base}")
    return {entity: schemas[entity] for entity in entities}, {entity: row_tags[entity] for entity in entities}
