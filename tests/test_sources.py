"""Reading registry folders: file rules, both XML scans, schema documents."""

import random

import pytest
from pyspark.sql import types as T

from addrspark.sources import files, sections, xml_tables
from addrspark.sources.schemas import declared_field, entity_of, primary_key, query_schema, select_tables
from addrspark.sources.xsd import find_schemas, read_schemas

XSD = """<?xml version="1.0" encoding="UTF-8"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="AddrObj"><xs:complexType><xs:sequence>
    <xs:element name="Object" minOccurs="0" maxOccurs="unbounded"><xs:complexType>
      <xs:attribute name="ID" use="required"><xs:simpleType><xs:restriction base="xs:long">
        <xs:totalDigits value="19"/></xs:restriction></xs:simpleType></xs:attribute>
      <xs:attribute name="NAME" use="required"><xs:simpleType><xs:restriction base="xs:string">
        <xs:minLength value="1"/><xs:maxLength value="250"/></xs:restriction></xs:simpleType></xs:attribute>
      <xs:attribute name="NOTE"><xs:simpleType><xs:restriction base="xs:string">
        <xs:maxLength value="8000"/></xs:restriction></xs:simpleType></xs:attribute>
      <xs:attribute name="KIND" use="required"><xs:simpleType><xs:restriction base="xs:integer">
        <xs:enumeration value="0"/><xs:enumeration value="1"/></xs:restriction></xs:simpleType></xs:attribute>
      <xs:attribute name="UPDATEDATE" type="xs:date" use="required"/>
      <xs:attribute name="ISACTIVE" type="xs:boolean" use="required"/>
    </xs:complexType></xs:element>
  </xs:sequence></xs:complexType></xs:element>
</xs:schema>
"""
ROWS = (
    '<?xml version="1.0" encoding="utf-8"?><AddrObjs>'
    '<Object ID="1" NAME="Test" KIND="1" UPDATEDATE="2025-01-31" ISACTIVE="true" />'
    '<Object ID="2" NAME="ИФНС &quot;ФЛ&quot; \\ a&lt;b /&gt; x /> y" NOTE="" KIND="0" UPDATEDATE="2025-02-01" ISACTIVE="false"/>'
    '<Object ID="3" NAME="it\'s &amp;#10; ok" NOTE="l1&#10;l2" KIND="0" UPDATEDATE="2025-02-01" ISACTIVE="false"></Object>'
    "</AddrObjs>"
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "AS_ADDR_OBJ_2_251.XSD").write_text(XSD, encoding="utf-8")
    for region in ("01", "77"):
        (tmp_path / region).mkdir()
        (tmp_path / region / "AS_ADDR_OBJ_20250131_ab-12.XML").write_text("﻿" + ROWS, encoding="utf-8")
        (tmp_path / region / "AS_ADDR_OBJ_PARAMS_20250131.XML").write_text("<PARAMS/>")
    (tmp_path / "77" / "AS_HOUSES.xml").write_text("<HOUSES></HOUSES>")
    (tmp_path / "77" / "AS_HOUSES_20250131.XML").write_text("<HOUSES></HOUSES>")
    (tmp_path / "AS_OBJECT_LEVELS_20250131.XML").write_text('<OBJECTLEVELS>\n  <OBJECTLEVEL LEVEL="1" NAME="a"/>\n</OBJECTLEVELS>\n')
    (tmp_path / "7a").mkdir()
    (tmp_path / "7a" / "AS_ADDR_OBJ_20250131.XML").write_text(ROWS, encoding="utf-8")
    return str(tmp_path)


def scan(spark, folder, **options):
    schemas, tags = read_schemas(spark, folder, ["ADDR_OBJ"])
    return xml_tables.scan_regions(
        spark, folder, "ADDR_OBJ", schema=schemas["ADDR_OBJ"], row_tag=tags["ADDR_OBJ"], **options
    )


def test_schema_document(spark, folder):
    schemas, tags = read_schemas(spark, folder, ["ADDR_OBJ"])
    assert tags == {"ADDR_OBJ": "Object"}
    schema = schemas["ADDR_OBJ"]
    assert schema.names == ["ID", "NAME", "NOTE", "KIND", "UPDATEDATE", "ISACTIVE"]
    assert [f.dataType for f in schema] == [
        T.LongType(), T.StringType(), T.StringType(), T.IntegerType(), T.DateType(), T.BooleanType()
    ]
    assert [f.nullable for f in schema] == [False, True, True, False, False, False]
    assert schema["NAME"].metadata == {"max_length": 250} and schema["NOTE"].metadata == {}


@pytest.mark.parametrize("facts, kind", [
    ({"base": "integer", "digits": 5}, T.ShortType()), ({"base": "int", "digits": 10}, T.IntegerType()),
    ({"base": "long", "digits": 19}, T.LongType()), ({"base": "long", "digits": 7}, T.IntegerType()),
    ({"base": "byte"}, T.ShortType()), ({"base": "date"}, T.DateType()), ({"type_name": "date"}, T.DateType()),
    ({"type_name": "boolean"}, T.BooleanType()), ({"type_name": "integer"}, T.IntegerType()),
    ({"type_name": "long"}, T.LongType()), ({"type_name": "anyURI"}, T.StringType()),
])
def test_type_rules(facts, kind):
    field = declared_field("X", **facts, required=True)
    assert field.dataType == kind and not field.nullable


def test_text_lengths():
    assert declared_field("X", base="string").metadata == {"max_length": 128}
    assert declared_field("X", base="string", length=256).metadata == {}
    assert declared_field("X", base="string", length=255, required=True).nullable


def test_both_scans_agree(spark, folder):
    pieces, documents = scan(spark, folder), scan(spark, folder, whole_files=True)
    rows = [tuple(row) for row in pieces.where("region = '77'").orderBy("id").collect()]
    assert [row[:4] for row in rows] == [
        (1, "Test", None, 1), (2, 'ИФНС "ФЛ" \\ a<b /> x /> y', "", 0), (3, "it's &#10; ok", "l1\nl2", 0),
    ]
    assert [row[5] for row in rows] == [True, False, False] and str(rows[0][4]) == "2025-01-31"
    assert sorted(pieces.collect()) == sorted(documents.collect())
    assert {row["region"] for row in pieces.collect()} == {"01", "77"}


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "50").mkdir()
    body = "".join(f'<HOUSE OBJECTID="{i}" HOUSENUM="{i} &quot;a&quot;" ISACTUAL="1"/>' for i in range(20000))
    (tmp_path / "50" / "AS_HOUSES_1.XML").write_text(f"<HOUSES>{body}</HOUSES>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        houses = xml_tables.scan_regions(spark, str(tmp_path), "HOUSES")
        assert houses.rdd.getNumPartitions() > 5
        assert houses.selectExpr("count(*)", "sum(objectid)", "count(distinct housenum)").collect()[0][:] == (
            20000, 19999 * 10000, 20000
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_malformed_row_is_an_error(spark, tmp_path):
    (tmp_path / "50").mkdir()
    (tmp_path / "50" / "AS_HOUSES_1.XML").write_text('<HOUSES><HOUSE OBJECTID="x" ISACTUAL="1"/></HOUSES>')
    with pytest.raises(Exception):
        xml_tables.scan_regions(spark, str(tmp_path), "HOUSES").collect()


def write_houses(tmp_path, text):
    (tmp_path / "50").mkdir(exist_ok=True)
    (tmp_path / "50" / "AS_HOUSES_1.XML").write_text(text, encoding="utf-8")
    return str(tmp_path)


@pytest.mark.parametrize("rows", [
    '<HOUSE\nOBJECTID="1" ISACTUAL="1"/>', '<HOUSE OBJECTID="1" ISACTUAL="1"/><HOUSE\tOBJECTID="2" ISACTUAL="1"/>',
    '<HOUSE OBJECTID="1" HOUSENUM="a --> / b /> ]]> \'c\'" ISACTUAL="1" ></HOUSE ><?note x?><HOUSE OBJECTID=\'2\' ISACTUAL="0"/>',
    '<!-- a > b --><HOUSE OBJECTID="1" ISACTUAL="1"><!-- c --></HOUSE><![CDATA[ <x ]]>', '<HOUSE/>', '',
])
def test_markup_between_and_in_rows(spark, tmp_path, rows):
    base = write_houses(tmp_path, f'<?xml version="1.0"?>\n<HOUSES>{rows}</HOUSES>\n<!-- end -->')
    whole = xml_tables.scan_regions(spark, base, "HOUSES", whole_files=True).collect()
    assert sorted(xml_tables.scan_regions(spark, base, "HOUSES").collect()) == sorted(whole)
    assert sorted(xml_tables.scan_regions(spark, base, "HOUSES", carry_sections=True).collect()) == sorted(whole)


@pytest.mark.parametrize("text", [
    '<HOUSES><HOUSE OBJECTID="1" ISACTUAL="1"/><!-- <HOUSE OBJECTID="2" ISACTUAL="1"/> --></HOUSES>',
    '<HOUSES><![CDATA[<HOUSE OBJECTID="2" ISACTUAL="1"/>]]><HOUSE OBJECTID="1" ISACTUAL="1"/></HOUSES>',
    '<!-- <HOUSE OBJECTID="2" ISACTUAL="1"/> --><HOUSES><HOUSE OBJECTID="1" ISACTUAL="1"/></HOUSES>',
])
def test_rows_in_sections(spark, tmp_path, text):
    base = write_houses(tmp_path, text)
    with pytest.raises(Exception, match="read the files whole"):
        xml_tables.scan_regions(spark, base, "HOUSES").collect()
    rows = xml_tables.scan_regions(spark, base, "HOUSES", carry_sections=True).collect()
    assert [row["objectid"] for row in rows] == [1]


def test_unfinished_row_is_an_error(spark, tmp_path):
    base = write_houses(tmp_path, '<HOUSES><HOUSE OBJECTID="1" ISACTUAL="1"/><HOUSE OBJECTID="2" ')
    for carry in (False, True):
        with pytest.raises(Exception, match="has no end"):
            xml_tables.scan_regions(spark, base, "HOUSES", carry_sections=carry).collect()


def test_sections_over_parts_of_a_file(spark, tmp_path):
    """Comments and CDATA with thousands of rows each, over the borders of parts; equal to a plain removal."""
    rng, texts, kept, number = random.Random(5), ["<HOUSES>"], [], 0
    for block in range(60):
        opened, closed = [("", ""), ("<!-- ", "-->"), ("<![CDATA[ --> ", "]]>"), ("<?old ]]> ", "?>")][block % 4]
        texts.append(opened)
        for _ in range(rng.choice([1, 40, 400])):
            number += 1
            note = rng.choice(["", ' HOUSENUM="--&gt; 1"'])
            texts.append(f'<HOUSE{rng.choice(" " + chr(10))}OBJECTID="{number}"{note} ISACTUAL="1"/>')
            if not opened:
                kept.append(number)
                texts.append(rng.choice(["", "<!-- x -->"]))
        texts.append(closed)
    base = write_houses(tmp_path, "".join(texts) + "</HOUSES>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        houses = xml_tables.scan_regions(spark, base, "HOUSES", carry_sections=True)
        pieces = xml_tables._pieces(spark, f"{base}/50", "HOUSE")
        starts = sections.part_starts(sections.part_ends(pieces)).collect()
        assert len(starts) > 20 and {row["state"] for row in starts} == {0, 1, 2, 3}
        assert sorted(row["objectid"] for row in houses.collect()) == kept
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_state_after():
    assert [sections.state_after("a --> b <!-- c", state) for state in range(4)] == [1, 1, 2, 3]
    assert sections.state_after("<![CDATA[ <!-- ]]> <? <!-- ?>", 0) == 0
    assert sections.state_after("", 2) == 2


def test_schemas_are_found(spark, folder, tmp_path):
    """All tables of documents beside the data, parameter tables too; what has none is an error that names it."""
    param = XSD.replace('name="Object"', 'name="Param"').replace('"NOTE"', '"VALUE"')
    (tmp_path / "AS_PARAM_2_251.xsd").write_text(param, encoding="utf-8")
    schemas, tags = find_schemas(spark, folder)
    assert tags == {"ADDR_OBJ": "Object", "PARAM": "Param"} and schemas["PARAM"].names[2] == "VALUE"
    tables = xml_tables.scan_registry(spark, folder, ["ADDR_OBJ", "ADDR_OBJ_PARAMS", "OBJECT_LEVELS"])
    assert tables["addr_obj"].columns == ["id", "name", "note", "kind", "updatedate", "isactive", "region"]
    assert tables["addr_obj"].count() == 6 and tables["addr_obj_params"].columns[2] == "value"
    (tmp_path / "50").mkdir()
    (tmp_path / "50" / "AS_CARPLACES_1.XML").write_text("<CARPLACES/>")
    (tmp_path / "50" / "AS_ADM_HIERARCHY_1.XML").write_text("<ITEMS/>")
    with pytest.raises(KeyError, match="ADM_HIERARCHY, CARPLACES"):
        xml_tables.scan_registry(spark, folder, ["CARPLACES", "ADM_HIERARCHY"], ["50"])
    with pytest.raises(FileNotFoundError, match="HOUSES"):
        read_schemas(spark, folder, ["PARAM", "HOUSES"])


def test_schema_documents_that_are_wrong(spark, folder, tmp_path):
    (tmp_path / "AS_ADDR_OBJ_2_252.xsd").write_text(XSD, encoding="utf-8")
    with pytest.raises(ValueError, match="several schema documents for ADDR_OBJ"):
        find_schemas(spark, folder)
    other = tmp_path / "other"
    other.mkdir()
    assert find_schemas(spark, str(other)) == ({}, {})
    (other / "AS_ROOMS.xsd").write_text(XSD.replace("sequence", "choice"), encoding="utf-8")
    with pytest.raises(ValueError, match="no row element .* ROOMS"):
        find_schemas(spark, str(other))


def test_unknown_row_element(spark, tmp_path):
    with pytest.raises(KeyError, match="schema document"):
        xml_tables.scan_regions(spark, str(tmp_path), "CARPLACES")


def test_regions_are_pruned(spark, folder):
    houses = scan(spark, folder, regions=["01"])
    assert {path.split("/")[-2] for path in houses.inputFiles()} == {"01"}
    assert {row["region"] for row in houses.collect()} == {"01"}


def test_file_listing(spark, folder):
    listing = files.list_files(spark, folder)
    found = sorted((row["table"], row["region"] or "") for row in listing.collect())
    assert found == [
        ("ADDR_OBJ", "01"), ("ADDR_OBJ", "77"), ("ADDR_OBJ_PARAMS", "01"), ("ADDR_OBJ_PARAMS", "77"),
        ("HOUSES", "77"), ("HOUSES", "77"), ("OBJECT_LEVELS", ""),
    ]
    assert [row[0] for row in files.list_regions(listing).collect()] == ["01", "77"]
    problems = files.file_problems(listing, ["ADDR_OBJ", "HOUSES", "OBJECT_LEVELS"], files.list_regions(listing))
    assert [tuple(row) for row in problems.collect()] == [("HOUSES", "01", 0), ("HOUSES", "77", 2)]
    sizes = {row["table_name"]: row["bytes"] for row in files.table_sizes(listing).collect()}
    assert sizes["houses"] == 2 * len("<HOUSES></HOUSES>")


def test_scan_registry(spark, folder):
    schemas, tags = read_schemas(spark, folder, ["ADDR_OBJ"])
    tables = xml_tables.scan_registry(spark, folder, ["ADDR_OBJ", "OBJECT_LEVELS"], ["77"], schemas, tags)
    assert tables["addr_obj"].count() == 3 and tables["object_levels"].collect()[0][:] == (1, "a")
    with pytest.raises(FileNotFoundError, match="99"):
        xml_tables.scan_registry(spark, folder, ["ADDR_OBJ"], ["77", "99"])
    with pytest.raises(FileNotFoundError, match="HOUSES 77 2"):
        xml_tables.scan_registry(spark, folder, ["HOUSES"], ["77"])


def test_copies_and_empty_regions(spark, folder, tmp_path):
    """Only the base and the regions' folders hold table files; a region without files is a problem."""
    for copy in ("backup/77", "77/old", "old"):
        (tmp_path / copy).mkdir(parents=True)
        for name in ("AS_ADDR_OBJ_20250131.XML", "AS_OBJECT_LEVELS_20250131.XML"):
            (tmp_path / copy / name).write_text(ROWS, encoding="utf-8")
    schemas, tags = read_schemas(spark, folder, ["ADDR_OBJ"])
    tables = xml_tables.scan_registry(spark, folder, ["ADDR_OBJ", "OBJECT_LEVELS"], None, schemas, tags)
    assert tables["addr_obj"].count() == 6 and tables["object_levels"].count() == 1
    (tmp_path / "50").mkdir()
    assert [row["region"] for row in files.region_folders(spark, folder).collect()] == ["01", "50", "77"]
    with pytest.raises(FileNotFoundError, match="ADDR_OBJ 50 0"):
        xml_tables.scan_registry(spark, folder, ["ADDR_OBJ"], None, schemas, tags)


def test_all_problems_are_counted(spark, tmp_path):
    for region in range(30):
        (tmp_path / f"{region + 10}").mkdir()
    (tmp_path / "AS_OBJECT_LEVELS.XML").write_text("<OBJECTLEVELS></OBJECTLEVELS>")
    with pytest.raises(FileNotFoundError, match="30 in all"):
        xml_tables.scan_registry(spark, str(tmp_path), ["HOUSES"])


def test_tables():
    assert len(select_tables()) == 28 and len({entity_of(name) for name in select_tables()}) == 22
    assert select_tables(["houses", "OBJECT_LEVELS"]) == ["OBJECT_LEVELS", "HOUSES"]
    assert entity_of("steads_params") == "PARAM" and entity_of("ADDHOUSE_TYPES") == "HOUSE_TYPES"
    assert [primary_key(t) for t in ("HOUSES", "OBJECT_LEVELS", "CHANGE_HISTORY", "REESTR_OBJECTS")] == [
        "id", "level", "changeid", "objectid"
    ]
    with pytest.raises(ValueError):
        select_tables(["NOPE"])
    assert query_schema("HOUSES")["HOUSENUM"].metadata == {"max_length": 50}
