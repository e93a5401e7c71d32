"""Reading registry tables from XML, one row per element, one column per attribute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from addrspark.shared import materialize
from addrspark.sources import sections
from addrspark.sources.files import (
    REGION_FOLDER,
    file_problems,
    list_files,
    missing_regions,
    region_folders,
    table_glob,
)
from addrspark.sources.schemas import COMMON_TABLES, QUERY_SCHEMAS, entity_of, lower_names, query_schema, select_tables
from addrspark.sources.xsd import find_schemas

# The element of a row, by entity.
ROW_TAGS = {
    "OBJECT_LEVELS": "OBJECTLEVEL",
    "ADDR_OBJ": "OBJECT",
    "MUN_HIERARCHY": "ITEM",
    "HOUSES": "HOUSE",
    "APARTMENTS": "APARTMENT",
    "ROOMS": "ROOM",
    "STEADS": "STEAD",
    "NORMATIVE_DOCS": "NORMDOC",
}
ATTRIBUTES_ONLY = {"attributePrefix": "", "mode": "FAILFAST"}


# The start tag of a row after its name, up to its end; a ``>`` may stand inside a value.
START_TAG = r"""^((?:[^<>"'/]++|"[^"<]*+"|'[^'<]*+'|/(?!>))*+)/?>"""
BLANKS = " \t\r\n"
# Comments, CDATA sections and processing instructions, whole or without their end.
WHOLE_SECTION = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
OPEN_SECTION = r"<!--|<!\[CDATA\[|<\?"


def _pieces(spark: SparkSession, paths: str | list[str], row_tag: str) -> DataFrame:
    """The text after each ``<row_tag`` (and before the first), read by many tasks."""
    return spark.read.option("lineSep", f"<{row_tag}").text(paths).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def _parsed(pieces: DataFrame, row_tag: str, schema: T.StructType, admitted: Column | None = None) -> DataFrame:
    """The pieces that begin in a start tag, as rows. A longer name, or the text before the first row, is none.

    Most pieces are one empty element and blanks, which is told without a regular expression. The others must be
    ``admitted``, if that is given.
    """
    value = F.col("value")
    alone = value.startswith(" ") & value.contains('"') & ~value.contains("<")
    in_tag = value.rlike(r"^[\s/>]") & ~value.rlike(r"^\s*(<|$)")
    wanted = in_tag if admitted is None else admitted & in_tag
    tag = F.regexp_extract("value", START_TAG, 0)
    unfinished = F.raise_error(F.lit(f"a {row_tag} element has no end")).cast("string")
    attributes = F.when(tag == "", unfinished).otherwise(F.regexp_extract("value", START_TAG, 1))
    name, end = F.lit(f"<{row_tag}"), F.col("_tag").endswith("/>") & (F.instr("_tag", ">") == F.length("_tag"))
    row = F.when(alone & end, F.concat(name, "_tag")).otherwise(F.concat(name, attributes, F.lit("/>")))
    return (
        pieces.where(F.when(alone, True).otherwise(wanted))
        .withColumn("_tag", F.rtrim("value", F.lit(BLANKS)))
        .select(F.from_xml(row, schema, ATTRIBUTES_ONLY).alias("row"), "_file")
        .select("row.*", "_file")
    )


def scan_files(spark: SparkSession, paths: str | list[str], row_tag: str, schema: T.StructType) -> DataFrame:
    """Rows of XML files, read in pieces by many tasks.

    The XML source reads a file in one task, and a region's file is large and may
    have no line breaks. So the files are cut as text at the start of each row
    element (a bare ``<`` cannot stand inside an attribute), and the start tag of each
    piece is parsed by itself. Comments, CDATA and processing instructions may stand
    between rows; one that holds a row element is an error, as its pieces may lie in
    several tasks: ``scan_sections`` reads such files.
    """
    pieces = _pieces(spark, paths, row_tag)
    rest = F.regexp_replace("value", WHOLE_SECTION, "")
    is_open = F.col("value").rlike(OPEN_SECTION) & rest.rlike(OPEN_SECTION)
    error = F.raise_error(
        F.lit(f"{row_tag} elements in a comment or CDATA: carry sections over pieces, or read the files whole")
    ).cast("boolean")
    return _parsed(pieces, row_tag, schema, F.when(is_open, error).otherwise(True))


def scan_sections(spark: SparkSession, paths: str | list[str], row_tag: str, schema: T.StructType) -> DataFrame:
    """As ``scan_files``, for any files: row elements inside comments, CDATA and instructions are left out.

    Whether a piece lies in such a section depends on all text before it, also in the parts of the file that other
    tasks read. So the files are read twice: first to find, for each part, in which section it ends, if it began in
    none or in one of each kind; these are put together along each file. Then the pieces are read with the answer.
    """
    pieces = _pieces(spark, paths, row_tag)
    ends = sections.part_ends(pieces)
    starts = materialize(sections.part_starts(ends), "xml-parts")
    return _parsed(sections.outside(pieces, starts), row_tag, schema)


def scan_documents(spark: SparkSession, paths: str | list[str], row_tag: str, schema: T.StructType) -> DataFrame:
    """Rows of XML files, each file read by one task with the XML source."""
    reader = spark.read.format("xml").options(rowTag=row_tag, **ATTRIBUTES_ONLY).schema(schema)
    return reader.load(paths).select("*", F.col("_metadata.file_path").alias("_file"))


def row_tag_of(table: str) -> str:
    entity = entity_of(table)
    if entity not in ROW_TAGS:
        raise KeyError(f"no built-in row element for {table}: give its schema document")
    return ROW_TAGS[entity]


def _lower(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.withColumnsRenamed({name: name.lower() for name in schema.names})


def _scan(
    spark: SparkSession, paths: str, row_tag: str, schema: T.StructType, whole_files: bool, carry_sections: bool
) -> DataFrame:
    read = scan_documents if whole_files else scan_sections if carry_sections else scan_files
    return read(spark, paths, row_tag, schema)


def scan_common(
    spark: SparkSession, base: str, table: str, schema: T.StructType | None = None, row_tag: str | None = None,
    whole_files: bool = False, carry_sections: bool = False,
) -> DataFrame:
    """A table without regions."""
    schema, row_tag = schema or query_schema(table), row_tag or row_tag_of(table)
    rows = _scan(spark, f"{base}/{table_glob(table)}", row_tag, schema, whole_files, carry_sections)
    return _lower(rows.drop("_file"), schema)


def scan_regions(
    spark: SparkSession, base: str, table: str, regions: list[str] | None = None,
    schema: T.StructType | None = None, row_tag: str | None = None, whole_files: bool = False,
    carry_sections: bool = False,
) -> DataFrame:
    """A table over all or some regions, with the ``region`` each row is from.

    Only the folders of the given regions are listed and read.
    """
    schema, row_tag = schema or query_schema(table), row_tag or row_tag_of(table)
    folders = "[0-9]*" if regions is None else "{" + ",".join(sorted(set(regions))) + "}"
    rows = _scan(spark, f"{base}/{folders}/{table_glob(table)}", row_tag, schema, whole_files, carry_sections)
    region = F.regexp_extract("_file", REGION_FOLDER, 1)
    return _lower(rows.withColumn("region", region).drop("_file").where("region <> ''"), schema)


def scan_registry(
    spark: SparkSession, base: str, tables: list[str], regions: list[str] | None = None,
    schemas: dict[str, T.StructType] | None = None, row_tags: dict[str, str] | None = None,
    schema_base: str | None = None, carry_sections: bool = False,
) -> dict[str, DataFrame]:
    """Tables by lower-case name, after checking that each has one file per region.

    Columns, types and row element of a table are those of its entity's schema document in ``schema_base`` (by
    default the base folder), else the built-in ones. ``schemas`` and ``row_tags`` are by entity and come first.
    """
    files = list_files(spark, base).cache()
    try:
        available = region_folders(spark, base)
        if regions is not None:
            requested = spark.createDataFrame([(region,) for region in regions], "region string")
            _raise_first(missing_regions(files, requested, available), "requested regions not found")
            available = available.join(requested, "region", "left_semi")
        tables = select_tables(tables)
        _raise_first(file_problems(files, tables, available), "not exactly one file for")
    finally:
        files.unpersist()
    found_schemas, found_tags = find_schemas(spark, schema_base or base)
    schemas, row_tags = QUERY_SCHEMAS | found_schemas | (schemas or {}), ROW_TAGS | found_tags | (row_tags or {})
    unknown = [name for name in tables if entity_of(name) not in schemas or entity_of(name) not in row_tags]
    if unknown:
        raise KeyError(f"no schema document for {', '.join(unknown)}")
    result = {}
    for table in tables:
        entity = entity_of(table)
        schema, tag = schemas[entity], row_tags[entity]
        if table in COMMON_TABLES:
            result[table.lower()] = scan_common(spark, base, table, schema, tag, carry_sections=carry_sections)
        else:
            result[table.lower()] = scan_regions(
                spark, base, table, regions, schema, tag, carry_sections=carry_sections)
    return result


def _raise_first(problems: DataFrame, message: str, shown: int = 20) -> None:
    rows = problems.limit(shown + 1).collect()
    if rows:
        named = ", ".join(" ".join(str(value) for value in row) for row in rows[:shown])
        more = f" and others, {problems.count()} in all" if len(rows) > shown else ""
        raise FileNotFoundError(f"{message}: {named}{more}")


def loaded_schema(table: str) -> T.StructType:
    """The schema of a scanned table, without the region."""
    return lower_names(query_schema(table))
