"""The registered operators: checks, expressions, joins, sinks and sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from addrspark.checks.queries import Query, over_registry
from addrspark.checks.xml_fixture import DECLARED, ELEMENTS, REGION_TABLES, declared_folder, registry_folder, sections_folder
from addrspark.fixtures import derived_registry
from addrspark.functions import names, paths
from addrspark.functions.text import keyword, ngrams
from addrspark.operators import quality as qua
from addrspark.operators.addresses import path_steps, place_steps
from addrspark.plans import addresses as adr, hierarchy as hie, wide as wid
from addrspark.registry import Registry
from addrspark.shared import materialize, new_folder
from addrspark.sinks import render
from addrspark.sinks.write import LAYOUTS, load_table, write_dump
from addrspark.sources import files, xml_tables
from addrspark.sources.schemas import lower_names, query_schema
from addrspark.sources.xsd import find_schemas


def text_form(reg: Registry, table: str) -> tuple[DataFrame, T.StructType]:
    """A table as the texts of its attributes, and the schema to read them by."""
    df = reg.table(table)
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns]), lower_names(query_schema(table))


def typed_houses(reg: Registry) -> DataFrame:
    return qua.typed(*text_form(reg, "houses"))


def unparsed_houses(reg: Registry) -> DataFrame:
    """With the additional numbers declared as integers, which some are not."""
    text, schema = text_form(reg, "houses")
    numbers = [T.StructField(f.name, T.IntegerType() if f.name.startswith("addnum") else f.dataType) for f in schema]
    return qua.unparsed(text, T.StructType(numbers))


def boolean_numbers(reg: Registry) -> DataFrame:
    rows = reg.table("addr_obj")
    declared = F.when(F.col("isactive") == 1, "true").otherwise("false")
    return rows.select("objectid", "name", qua.boolean_number(declared).cast("bigint").alias("isactive"))


def tagged(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), "*")


CHECKED = ["addr_obj", "apartments", "houses", "mun_hierarchy", "normative_docs", "rooms", "steads"]


def missing_required(reg: Registry) -> DataFrame:
    """With the parent id taken as required, which roots do not have."""
    reports = []
    for table in CHECKED:
        schema = lower_names(query_schema(table))
        for field in schema.fields:
            field.nullable = field.nullable and field.name != "parentobjid"
        reports.append(tagged(qua.missing_required(reg.table(table), schema), table))
    return reduce(DataFrame.unionByName, reports)


def too_long(reg: Registry) -> DataFrame:
    limits = {"name": 8, "typename": 9, "level": 10}
    schema = [T.StructField(name, T.StringType(), True, {"max_length": n}) for name, n in limits.items()]
    return qua.too_long(reg.table("addr_obj"), T.StructType(schema))


def repeated_keys(reg: Registry) -> DataFrame:
    keys = {t: "objectid" for t in CHECKED} | {"normative_docs": "id", "object_levels": "level"}
    return reduce(DataFrame.unionByName, [tagged(qua.duplicate_keys(reg.table(t), k), t) for t, k in keys.items()])


def loaded_twice(reg: Registry) -> DataFrame:
    return qua.duplicate_objects(reg.table("houses").union(reg.table("houses")))


def quality() -> dict[str, Query]:
    return {
        "q1_typed": over_registry(typed_houses),
        "q1_unparsed": over_registry(unparsed_houses),
        "q2_boolean_numbers": over_registry(boolean_numbers),
        "q3_missing_required": over_registry(missing_required),
        "q4_too_long": over_registry(too_long),
        "q5_duplicate_keys": over_registry(repeated_keys),
        "q5_primary_keys": lambda spark, sf_dir: qua.duplicate_primary_keys(declared_tables(spark, sf_dir)),
        "q6_duplicate_objects": over_registry(lambda reg: qua.duplicate_objects(reg.table("addr_obj"))),
        "q6_duplicate_objects_loaded_twice": over_registry(loaded_twice),
        "q7_object_counts": over_registry(qua.object_counts),
        "q8_object_totals": over_registry(qua.object_totals),
        "q9_missing_names": over_registry(qua.missing_names),
        "q10_largest_tables": over_registry(qua.largest_tables),
        "q10_sized_tables": sized_tables,
        "q11_check_expected": over_registry(lambda reg: qua.check_expected(reg, 17000, 0.1)),
        "q11_check_expected_none": over_registry(lambda reg: qua.check_expected(reg, 0)),
        "q12_load_monitor": over_registry(lambda reg: qua.largest_tables(reg, 10)),
        "q13_table_counts": over_registry(lambda reg: qua.row_counts(reg, ["houses", "apartments", "addr_obj"])),
    }


def expressions() -> dict[str, Query]:
    def steps(reg: Registry) -> DataFrame:
        return path_steps(reg.table("mun_hierarchy").select("objectid", "path"))

    def documents(*columns) -> Query:
        return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *columns)

    def path_columns() -> list:
        ids = paths.path_ids("path")
        first, last = F.get(ids, F.lit(0)), F.element_at(ids, -1)
        return ["objectid", F.size(ids).cast("bigint").alias("n_ids"), first.alias("first_id"), last.alias("last_id")]

    def indented(reg: Registry) -> DataFrame:
        depth = F.size(paths.path_ids("path")) - 1
        rows = reg.places.join(reg.hierarchy, "objectid")
        return rows.select("objectid", names.indented("name", depth).alias("name_indented"))

    def prefixes(reg: Registry) -> DataFrame:
        found = {"by_text": paths.under("1"), "by_step": paths.under("1", strict=True), "below": paths.below("1")}
        return reg.table("mun_hierarchy").select("path", *[c.cast("int").alias(name) for name, c in found.items()])

    def predicates(reg: Registry) -> DataFrame:
        level = F.col("level_num")
        return reg.places.where((level.between(3, 7) | level.isin(1, 10)) & (level <= 8)).select("objectid", "level_num")

    def with_default(reg: Registry) -> DataFrame:
        labels = reg.places.select("objectid", "label")
        rows = reg.table("mun_hierarchy").select("objectid").join(labels, "objectid", "left")
        return rows.select("objectid", names.or_not_found("label").alias("label"))

    def pairs(reg: Registry) -> DataFrame:
        ids = F.array_append(F.array("objectid"), F.col("parentobjid"))
        return reg.table("mun_hierarchy").select(
            "objectid", F.array_join(ids.cast("array<string>"), "<", "none").alias("pair")
        )

    def apartment_suffixes(reg: Registry) -> DataFrame:
        return reg.table("apartments").select(
            "objectid",
            names.apartment_suffix("number", required=True).alias("required"),
            names.apartment_suffix(F.nullif(F.col("number"), F.lit("1"))).alias("optional"),
        )

    def room_suffixes(reg: Registry) -> DataFrame:
        suffix = names.room_suffix(F.nullif(F.col("number"), F.lit("2")))
        return reg.table("rooms").select("objectid", suffix.alias("suffix"))

    def contained(spark: SparkSession, sf_dir: str) -> DataFrame:
        both = names.contains_text("text", "the") & names.contains_text("text", "And")
        return documents(
            names.contains_text("text", "É").cast("int").alias("with_accent"), both.cast("int").alias("with_both")
        )(spark, sf_dir)

    # Columns need a session, so they are made when the query runs.
    def later(table: str, make: Callable[[], list]) -> Query:
        return over_registry(lambda reg: reg.table(table).select(*make()))

    def later_documents(make: Callable[[], list]) -> Query:
        return lambda spark, sf_dir: documents(*make())(spark, sf_dir)

    return {
        "e1_display_name": later("addr_obj", lambda: ["objectid", names.display_name("typename", "name").alias("label")]),
        "e2_house_suffix": later("houses", lambda: ["objectid", names.house_suffix().alias("suffix")]),
        "e3_apartment_suffix": over_registry(apartment_suffixes),
        "e4_room_suffix": over_registry(room_suffixes),
        "e5_path_ids": later("mun_hierarchy", path_columns),
        "e6_path_steps": over_registry(lambda reg: steps(reg).select("objectid", "position", "element_id")),
        "e7_path_elements": over_registry(lambda reg: steps(reg).select("path", "element_id")),
        "e8_indented": over_registry(indented),
        "e9_house_type_name": later(
            "houses", lambda: ["objectid", names.house_type_name("housetype").alias("housetype_name")]),
        "e10_level_number": later(
            "addr_obj", lambda: ["objectid", "name", names.level_number("level").alias("level_num")]),
        "e11_under_prefix": over_registry(prefixes),
        "e12_contains_text": contained,
        "e13_predicates": over_registry(predicates),
        "e14_or_not_found": over_registry(with_default),
        "e15_array_append": over_registry(pairs),
        "e16_keyword": later_documents(lambda: [keyword("text").alias("keyword"), keyword("source").alias("source")]),
        "e17_ngrams": later_documents(lambda: [ngrams(keyword("text")).alias("grams")]),
        "e17_ngrams_of_names": later("addr_obj", lambda: ["objectid", ngrams(keyword("name")).alias("grams")]),
    }


def joins() -> dict[str, Query]:
    def active(reg: Registry) -> DataFrame:
        return reg.houses.join(reg.hierarchy, "objectid").select("objectid", "path")

    def parent_rows(reg: Registry) -> DataFrame:
        up = reg.hierarchy.select(F.col("objectid").alias("parentobjid"), F.col("path").alias("parent_path"))
        return reg.hierarchy.join(up, "parentobjid").select("objectid", "path", "parent_path")

    def children(reg: Registry) -> DataFrame:
        return wid.all_apartments(reg, keep_empty=True, ordered=False).select("level_10_objectid", "level_9_objectid")

    def path_places(reg: Registry) -> DataFrame:
        return place_steps(reg.hierarchy, reg.places).select("objectid", "position", "element_id", "label")

    return {
        "j1_active_objects": over_registry(active),
        "j2_parents": over_registry(lambda reg: adr.on_street(reg, F.lit(True)).select("objectid", "street_name")),
        "j3_parent_rows": over_registry(parent_rows),
        "j4_path_places": over_registry(path_places),
        "j5_level_names": over_registry(lambda reg: hie.with_level_name(reg.places, reg).select("objectid", "level_name")),
        "j6_children": over_registry(children),
        "w1_numbered_places": over_registry(lambda reg: hie.numbered_places(reg, "8")),
        "w2_chain_addresses": over_registry(lambda reg: hie.address_chain(reg).select("target_objectid", "full_address")),
    }


def events_and_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, line breaks, backslashes and missing values; a boolean; a date."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("id"), "text", F.when(F.col("lang") != "fr", F.col("lang")).alias("mark"),
        (F.col("n_chars") > 500).alias("long"), F.lit(None).cast("date").alias("day"),
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("id"), F.col("props").alias("text"),
        F.concat(F.lit("a\\b'c\td\r"), "event_type").alias("mark"), F.lit(None).cast("boolean").alias("long"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("event_id") % 1000).cast("int")).alias("day"),
    )
    return documents.unionAll(events)


def rendered(dialect: render.Dialect) -> Query:
    return lambda spark, sf_dir: render.row_lines(events_and_documents(spark, sf_dir), dialect)


def regional(reg: Registry, table: str) -> DataFrame:
    roots = reg.table("mun_hierarchy").select("objectid", paths.root_id().cast("string").alias("region"))
    return reg.table(table).join(roots, "objectid")


def statements(reg: Registry) -> DataFrame:
    houses = regional(reg, "houses").drop("objectguid", "isactual")
    return render.insert_statements(houses, "HOUSES", render.POSTGRES, ["objectid"], ("region",))


def dumped(platform: str, layout: str) -> Query:
    """Write the tables and read the lines back, with the folders they lie in."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, folder = derived_registry(spark, sf_dir), new_folder(spark, "dump")
        tables = {"OBJECT_LEVELS": reg.table("object_levels"), "HOUSES": regional(reg, "houses")}
        write_dump(tables, folder, platform, layout, keys={"HOUSES": ["objectid"]})
        if platform == "csv":
            lines = spark.read.text(folder).withColumnRenamed("value", "line")
        else:
            lines = spark.read.option("lineSep", ";\n").text(folder).withColumnRenamed("value", "line")
        return lines.select([F.col(c).cast("string").alias(c) for c in sorted(lines.columns)])
    return query


def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The house rows that each format and layout writes; NULL where the layout is refused for the format.

    The houses are stored once with their regions, so that only the dumps are made for each format and layout.
    """
    houses, found = materialize(regional(derived_registry(spark, sf_dir), "houses"), "houses"), []
    for platform in render.DIALECTS:
        for layout in LAYOUTS:
            folder, kind = new_folder(spark, "dump"), [F.lit(platform).alias("platform"), F.lit(layout).alias("layout")]
            try:
                write_dump({"HOUSES": houses}, folder, platform, layout, keys={"HOUSES": ["objectid"]})
            except ValueError:
                found.append(houses.agg(F.count("*")).select(*kind, F.lit(None).cast("bigint").alias("n_rows")))
            else:
                rows = spark.read.text(folder).where(~F.col("value").startswith("INSERT INTO"))
                found.append(rows.agg(F.count("*").alias("n_rows")).select(*kind, "n_rows"))
    return reduce(DataFrame.unionByName, found)


def loaded(append: bool) -> Query:
    """Load a table twice and count its rows by region."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, folder = derived_registry(spark, sf_dir), new_folder(spark, "load")
        for _ in range(2):
            load_table(regional(reg, "houses"), folder, append)
        rows = spark.read.parquet(folder)
        return rows.groupBy(F.col("region").cast("string").alias("region")).agg(F.count("*").alias("row_count"))
    return query


def dumped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables read from XML, written as they come, without keys."""
    folder = new_folder(spark, "dump")
    tables = xml_tables.scan_registry(spark, registry_folder(spark, sf_dir), ["OBJECT_LEVELS", "HOUSES"], _regions(spark, sf_dir))
    write_dump({name.upper(): df for name, df in tables.items()}, folder, "mysql", "per_region")
    lines = spark.read.option("lineSep", ";\n").text(folder).withColumnRenamed("value", "line")
    return lines.select("line", F.col("region").cast("string").alias("region"))


def _regions(spark: SparkSession, sf_dir: str) -> list[str]:
    found = files.list_regions(files.list_files(spark, registry_folder(spark, sf_dir)))
    return [row["region"] for row in found.collect()]  # one row per region


def sinks() -> dict[str, Query]:
    return {
        "k1_csv_lines": rendered(render.CSV),
        "k2_tsv_lines": rendered(render.TSV),
        "k3_postgres_lines": rendered(render.POSTGRES),
        "k3_postgres_standard_lines": rendered(render.POSTGRES_STANDARD),
        "k4_mysql_lines": rendered(render.MYSQL),
        "k5_insert_statements": over_registry(statements),
        "k6_region_tree": dumped("csv", "region_tree"),
        "k6_per_table": dumped("mysql", "per_table"),
        "k6_per_region": dumped("mysql", "per_region"),
        "k6_direct": dumped("mysql", "direct"),
        "k6_scanned_tables": dumped_scan,
        "k7_layouts": layouts,
        "k8_load": loaded(False),
        "k8_load_append": loaded(True),
    }


def scanned(table: str, regions: list[str] | None = None, whole_files: bool = False) -> Query:
    return lambda spark, sf_dir: xml_tables.scan_regions(
        spark, registry_folder(spark, sf_dir), table, regions, whole_files=whole_files
    )


def listed(query: Callable[[DataFrame, SparkSession], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(files.list_files(spark, registry_folder(spark, sf_dir)), spark)


def requested(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("1",), ("15",), ("99",)], "region string")


def problems(found: DataFrame, spark: SparkSession) -> DataFrame:
    tables = ["OBJECT_LEVELS", "ROOM_TYPES", "ROOMS", *REGION_TABLES]
    return files.file_problems(found, tables, files.list_regions(found))


def folder_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = registry_folder(spark, sf_dir)
    return files.file_problems(files.list_files(spark, folder), REGION_TABLES, files.region_folders(spark, folder))


def selected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = registry_folder(spark, sf_dir)
    tables = xml_tables.scan_registry(spark, folder, ["OBJECT_LEVELS", *REGION_TABLES], ["1", "15"])
    return qua.row_counts(Registry(tables), sorted(tables))


def declared_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return xml_tables.scan_registry(spark, declared_folder(spark, sf_dir), list(DECLARED))


def declared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of schema documents, a row as one text of its typed values."""
    tables = declared_tables(spark, sf_dir)
    texts = [
        tagged(df, name).select(
            "table_name", (F.col("region") if "region" in df.columns else F.lit(None).cast("string")).alias("region"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns if c != "region"]).alias("row_text"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, texts)


def schema_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas, tags = find_schemas(spark, declared_folder(spark, sf_dir))
    rows = [
        (entity, tags[entity], ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' required'}" for f in schema))
        for entity, schema in schemas.items()
    ]
    return spark.createDataFrame(rows, "entity string, row_tag string, columns string")


def sections_scan(table: str) -> Query:
    return lambda spark, sf_dir: xml_tables.scan_regions(
        spark, sections_folder(spark, sf_dir), table, carry_sections=True)


def sized_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bytes of the files of tables, the largest first."""
    folder = sections_folder(spark, sf_dir)
    tables = xml_tables.scan_registry(spark, folder, list(ELEMENTS), carry_sections=True)
    return qua.largest_tables(Registry(tables), sizes=files.table_sizes(files.list_files(spark, folder)))


def sources() -> dict[str, Query]:
    return {
        "s1_xml_scan": scanned("HOUSES"),
        "s1_xml_scan_whole_files": scanned("HOUSES", whole_files=True),
        "s1_xml_scan_sections": sections_scan("HOUSES"),
        "s2_table_files": listed(lambda found, spark: found.select("table", "region")),
        "s3_file_problems": listed(problems),
        "s4_regions": listed(lambda found, spark: files.list_regions(found)),
        "s3_empty_region": folder_problems,
        "s4_region_folders": lambda spark, sf_dir: files.region_folders(spark, registry_folder(spark, sf_dir)),
        "s5_missing_regions": listed(lambda found, spark: files.missing_regions(found, requested(spark))),
        "s5_selected_regions": listed(lambda found, spark: files.selected_regions(found, requested(spark))),
        "s6_multi_region_scan": scanned("MUN_HIERARCHY"),
        "s6_some_regions_scan": scanned("ADDR_OBJ", ["1", "15"]),
        "s7_common_scan": lambda spark, sf_dir: xml_tables.scan_common(
            spark, registry_folder(spark, sf_dir), "OBJECT_LEVELS"),
        "s8_selected_tables": selected_tables,
        "s8_schema_documents": schema_documents,
        "s8_declared_tables": declared_rows,
    }


def queries() -> dict[str, Query]:
    return quality() | expressions() | joins() | sinks() | sources()
