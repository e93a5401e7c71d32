"""The derived tables as a registry folder of XML files, to be read back.

A derived table is computed once: it is stored as parquet by the folder that its rows go to, and the XML files of a folder are
then written from its rows alone, or the files of all folders are written at once. They are compressed, at the level that
takes least time: as text they are some ten times the size of the base tables. A compressed file is read by one task; a
table has a file per task that wrote it.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from addrspark.fixtures import REGISTRY_TABLES, derived_registry
from addrspark.functions.paths import root_id
from addrspark.registry import Registry
from addrspark.shared import materialize, new_folder
from addrspark.sources.schemas import COMMON_TABLES, entity_of
from addrspark.sources.xml_tables import ROW_TAGS

DATE = "20250131"
EMPTY_REGION = "98"
REGION_TABLES = ["ADDR_OBJ", "MUN_HIERARCHY", "HOUSES"]

COMPRESSION = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

_folders: dict[tuple[str, str], str] = {}


def _write(df: DataFrame, folder: str, table: str) -> None:
    attributes = df.select(*[F.col(name).alias(f"_{name.upper()}") for name in df.columns])
    tag = ROW_TAGS[table]
    attributes.write.format("xml").options(rowTag=tag, rootTag=f"{tag}S", **COMPRESSION).save(
        f"{folder}/AS_{table}_{DATE}.XML")


def _stored_by(df: DataFrame, column: str, label: str) -> DataFrame:
    """``df`` stored with a folder for each text of ``column``, so that the rows of one are read without the others."""
    folder = new_folder(df.sparkSession, label)
    df.write.partitionBy(column).option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def registry_folder(spark: SparkSession, sf_dir: str) -> str:
    """Write the folder once per session and return its path."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _folders:
        reg, folder = derived_registry(spark, sf_dir), new_folder(spark, "xml")
        _write(reg.table("object_levels"), folder, "OBJECT_LEVELS")
        hierarchy = materialize(reg.table("mun_hierarchy"), "hierarchy")
        regions = hierarchy.select("objectid", root_id().cast("string").alias("region"))
        roots = [row["objectid"] for row in reg.table("addr_obj").where("level = '1'").collect()]
        for table in REGION_TABLES:
            rows = hierarchy if table == "MUN_HIERARCHY" else reg.table(table.lower())
            tagged = _stored_by(rows.join(regions, "objectid"), "region", "tagged")
            for root in roots:
                _write(tagged.where(F.col("region") == str(root)).drop("region"), f"{folder}/{root}", table)
        # What a listing must leave out, and a region without files.
        _write(reg.table("object_levels"), f"{folder}/backup", "OBJECT_LEVELS")
        _write(reg.table("object_levels"), f"{folder}/backup/1", "HOUSES")
        empty = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{EMPTY_REGION}")
        empty.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(empty)
        _folders[key] = folder
    return _folders[key]


# A date and a key for every table, so that a schema document has all types.
DAY = "CASE WHEN {} % 2 = 0 THEN DATE '2025-01-01' ELSE DATE '2024-02-29' END AS updatedate"
PARAMS = "SELECT objectid AS id, objectid, CAST(objectid % 7 AS INT) AS typeid, {value} AS value, " \
    + DAY.format("objectid") + " FROM {{{table}}}"
#: Tables whose columns are told by schema documents only; ``{name}`` stands for a derived table.
DECLARED = {
    "object_levels": f"SELECT t.*, level % 2 = 0 AS isactive, {DAY.format('level')} FROM {{object_levels}} t",
    "normative_docs": f"SELECT t.*, {DAY.format('id')} FROM {{normative_docs}} t",
    "addr_obj_params": PARAMS.format(value="name", table="addr_obj"),
    "houses_params": PARAMS.format(value="housenum", table="houses"),
} | {
    name: f"SELECT objectid AS id, t.*, {DAY.format('objectid')} FROM {{{name}}} t"
    for name in REGISTRY_TABLES if name not in ("object_levels", "normative_docs")
}
DECLARED_REGIONS = {"01": 0, "77": 1}

# Sections around ranges of rows: none, a comment, CDATA, an instruction.
SECTIONS = [("", ""), ("<!-- old", "-->"), ("<![CDATA[ --> ", "]]>"), ("<?old ]]>", "?>")]
RANGE = 64
#: The rows of a table as XML elements, one in a line.
ELEMENTS = {
    "HOUSES": """SELECT objectid, '<HOUSE' || CASE WHEN objectid % 3 = 0 THEN chr(9) ELSE ' ' END || 'OBJECTID="'
  || objectid || '" OBJECTGUID="' || objectguid || '"' || coalesce(' HOUSENUM="' || housenum || '"', '')
  || coalesce(' ADDNUM1="' || addnum1 || '"', '') || coalesce(' ADDNUM2="' || addnum2 || '"', '') || ' HOUSETYPE="'
  || housetype || '" ISACTUAL="' || isactual || '"/>' AS line FROM {houses}""",
    "STEADS": """SELECT objectid, '<STEAD OBJECTID="' || objectid || '" OBJECTGUID="' || objectguid
  || '" NUMBER="' || number || '" ISACTUAL="' || isactual || '"/>' AS line FROM {steads}""",
}


def _derived(reg: Registry, text: str) -> DataFrame:
    names = {field for _, field, _, _ in string.Formatter().parse(text) if field}
    return reg.table("object_levels").sparkSession.sql(text, **{name: reg.table(name) for name in names})


def _attribute(field: T.StructField) -> str:
    name, use = field.name.upper(), ' use="required"' if field.name in ("id", "level", "objectid") else ""
    plain = {T.DateType: "xs:date", T.BooleanType: "xs:boolean"}.get(type(field.dataType))
    if plain:
        return f'<xs:attribute name="{name}" type="{plain}"{use}/>'
    base, facet = {
        T.LongType: ("xs:long", '<xs:totalDigits value="19"/>'), T.IntegerType: ("xs:integer", '<xs:totalDigits value="10"/>'),
    }.get(type(field.dataType), ("xs:string", '<xs:maxLength value="250"/>'))
    return f'<xs:attribute name="{name}"{use}><xs:simpleType><xs:restriction base="{base}">{facet}' \
        "</xs:restriction></xs:simpleType></xs:attribute>"


def _write_schema(df: DataFrame, folder: str, entity: str, tag: str) -> None:
    text = '<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="ROWS">' \
        f'<xs:complexType><xs:sequence><xs:element name="{tag}"><xs:complexType>{"".join(map(_attribute, df.schema))}' \
        "</xs:complexType></xs:element></xs:sequence></xs:complexType></xs:element></xs:schema>"
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/AS_{entity}_2_251_01.xsd")


def _write_places(df: DataFrame, column: str, places: dict[str, str], options: dict[str, str]) -> None:
    """Write the rows of each text of ``column`` as XML to its place, all at once and without a sort by it."""
    spark, writers = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    folder, before = new_folder(spark, "places"), spark.conf.get(writers)
    spark.conf.set(writers, str(len(places) + 1))
    try:
        df.write.partitionBy(column).format("xml").options(**options).save(folder)
    finally:
        spark.conf.set(writers, before)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for place, text in places.items():
        written = path(f"{folder}/{column}={text}")
        if system.exists(written):
            system.mkdirs(path(place).getParent())
            if not system.rename(written, path(place)):
                raise OSError(f"{written} was not put at {place}")
        else:
            df.limit(0).drop(column).write.format("xml").options(**options).save(place)


def declared_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the tables of ``DECLARED`` and a schema document for each entity, written once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} declared")
    if key not in _folders:
        folder, written, reg = new_folder(spark, "xml"), set(), derived_registry(spark, sf_dir)
        for name, text in DECLARED.items():
            df, table = _derived(reg, text), name.upper()
            entity = entity_of(table)
            tag = ROW_TAGS.get(entity, entity)
            if entity not in written:
                _write_schema(df, folder, entity, tag)
                written.add(entity)
            attributes = df.select(*[F.col(column).cast("string").alias(f"_{column.upper()}") for column in df.columns])
            options = dict(rowTag=tag, rootTag="ROWS", valueTag="_TEXT", **COMPRESSION)
            file = f"AS_{table}_{DATE}.XML"
            if table in COMMON_TABLES:
                attributes.write.format("xml").options(**options).save(f"{folder}/{file}")
            else:
                rest = ((F.col("_ID") + F.floor(F.col("_ID") / 10)) % 2).cast("string")
                places = {f"{folder}/{region}/{file}": str(rest) for region, rest in DECLARED_REGIONS.items()}
                _write_places(attributes.withColumn("_rest", rest), "_rest", places, options)
        _folders[key] = folder
    return _folders[key]


def sections_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the tables of ``ELEMENTS``, where three of four ranges of rows lie in sections. A file has whole ranges."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} sections")
    if key not in _folders:
        folder, reg = new_folder(spark, "xml"), derived_registry(spark, sf_dir)
        for table, text in ELEMENTS.items():
            number = F.floor(F.col("objectid") / RANGE)
            rows = _derived(reg, text).select(number.alias("number"), F.col("objectid").alias("position"), "line")
            marks = [
                rows.select("number").distinct().select(
                    "number", F.lit(position).cast("bigint").alias("position"),
                    F.get(F.array(*[F.lit(pair[side]) for pair in SECTIONS]), (F.col("number") % len(SECTIONS)).cast("int")).alias("line"),
                )
                for side, position in ((0, -1), (1, 2**62))
            ]
            lines = rows.unionByName(marks[0]).unionByName(marks[1])
            lines.repartitionByRange(3, "number").sortWithinPartitions("number", "position").select("line").write.text(
                f"{folder}/50/AS_{table}_{DATE}.XML")
        _folders[key] = folder
    return _folders[key]
