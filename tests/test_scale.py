"""What the registered queries compute once, and what they write."""

import glob
import re
from xml.etree import ElementTree

import pytest
from pyspark.sql import Row, types as T

from addrspark.checks import operator_queries as opq, queries as plan_queries, xml_fixture
from addrspark.plans import wide as wid
from addrspark.registry import Registry
from addrspark.sinks.write import load_table
from addrspark.sources import path_bounds, xml_tables
from rows import house, link, place

SF_DIR = "/root/testdata/sf0.001"


def test_layouts_derive_the_houses_once(spark, monkeypatch):
    read = []

    def dump(tables, path, platform, layout, **options):
        read.append(tables["HOUSES"].inputFiles())
        raise ValueError("not written here")

    monkeypatch.setattr(opq, "write_dump", dump)
    opq.layouts(spark, SF_DIR)
    assert len(read) == 20 and not any("lineitem" in file for files in read for file in files)


def test_fixture_files_are_compressed(spark):
    for write in (xml_fixture.registry_folder, xml_fixture.declared_folder):
        files = glob.glob(f"{write(spark, SF_DIR)}/**/*.[xX][mM][lL]/part-*", recursive=True)
        assert files and all(file.endswith(".xml.gz") for file in files)


def test_fixture_rows_are_written_from_stored_tables(spark, monkeypatch):
    read, write = [], xml_fixture._write

    def watched(df, folder, table):
        read.extend(df.inputFiles() if table in xml_fixture.REGION_TABLES else [])
        write(df, folder, table)

    monkeypatch.setattr(xml_fixture, "_folders", {})
    monkeypatch.setattr(xml_fixture, "_write", watched)
    xml_fixture.registry_folder(spark, SF_DIR)
    folders = {file.rsplit("/", 2)[-2] for file in read if "region=" in file}
    assert len(folders) == 5 and not any("lineitem" in file for file in read)


def test_file_names_are_taken_once_per_file(spark, tmp_path):
    df = spark.range(100).selectExpr("id as objectid", "string(id) as path", "string(id % 2) as region")
    path = str(tmp_path / "mun_hierarchy")
    load_table(df, path)
    bounds = path_bounds.file_bounds(spark, path)
    assert {row.file.split("/")[0] for row in bounds.collect()} == {"region=0", "region=1"}
    assert (min(row.low for row in bounds.collect()), max(row.high for row in bounds.collect())) == ("0", "99")
    by_row = bounds._jdf.queryExecution().optimizedPlan().toString().rpartition("Project [")[2]
    assert "file_path" in by_row and "regexp" not in by_row  # names come after the aggregate


def test_empty_parents_do_not_work_out_children_again(stored):
    def scans(df, column):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return sum("Relation [" in line and f"{column}#" in line for line in plan.splitlines())

    flats, rooms = wid.all_apartments(stored, keep_empty=True), wid.all_rooms(stored, keep_empty=True)
    assert (scans(flats, "aparttype"), scans(rooms, "roomtype")) == (1, 1)
    assert scans(rooms, "aparttype") <= 3  # with rooms, without, and their ids


def test_single_rows_keep_empty_parents_once(make_registry):
    rows = dict(
        mun_hierarchy=[link("1"), link("1.10"), link("1.10.20"), link("1.10.20.30"), link("1.10.20.30.40"), link("1.10.20.50"),
                       link("1.10.20.60"), link("1.10.21"), link("1.10.22"), link("1.10.22.70")],
        addr_obj=[place(1, "R", "reg", 1), place(10, "S", "st", 8)],
        houses=[house(20, "1"), house(21, "2"), house(22, "3")],
        apartments=[(30, "g30", "1", 2, 1), (50, "g50", "2", 2, 1)],
        rooms=[(40, "g40", "4", 1, 1), (60, "g60", "6", 1, 1)],
    )
    columns = ["level_10_objectid", "level_9_objectid", "level_65_objectid"]
    reg = make_registry(**rows)
    for single in (False, True):
        found = wid.all_rooms(Registry(reg.tables, single), keep_empty=True).select(columns).collect()
        assert sorted(map(str, found)) == sorted(map(str, [
            Row(**dict(zip(columns, ids))) for ids in [(20, 30, 40), (20, 50, None), (20, None, None), (21, None, None), (22, None, None)]]))


def test_declared_tables_are_written_at_once(spark, monkeypatch):
    """All regions from one pass over the rows, with nothing stored in between; a region without rows has a file, too."""
    monkeypatch.setattr(xml_fixture, "_folders", {})
    stored = f"{spark.conf.get('spark.checkpoint.dir')}/addrspark/declared-*"
    before = set(glob.glob(stored))
    folder = xml_fixture.declared_folder(spark, SF_DIR)
    assert set(glob.glob(stored)) == before
    assert len(glob.glob(f"{folder}/*/AS_HOUSES_2*.XML/part-*")) >= 2
    rows = spark.range(5).selectExpr("string(id) as _ID", "if(id < 3, '0', null) as _rest")
    options = dict(rowTag="ROW", rootTag="ROWS", **xml_fixture.COMPRESSION)
    xml_fixture._write_places(rows, "_rest", {f"{folder}/places/{n}.XML": n for n in ("0", "1")}, options)
    read = [xml_tables.scan_files(spark, f"{folder}/places/{n}.XML", "ROW", T.StructType.fromDDL("ID long")) for n in ("0", "1")]
    assert [sorted(row.ID for row in df.collect()) for df in read] == [[0, 1, 2], []]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


@pytest.mark.parametrize("text", [
    "<R><A X='1' Y='>'/> <A X=\"2\" Y=\"a/>\"/><AB X=\"3\"/>\n<A X=\"4\" Y=\"'\"></A> <A\tX=\"5\"\n Y=\"&lt;\" /></R>",
    "<A X=\"1\"/>", "<A X=\"1\" Y=\" b \"/>\n<A X=\"2\"/>\n", "<A   \n", "<A/><A />", "<A Y=\"/>\" X=\"7\"/> ",
])
def test_lone_elements_are_rows_as_all_others(spark, tmp_path, text):
    """Pieces that are told without a regular expression give the rows that the expression finds."""
    (tmp_path / "a.xml").write_text(text)
    found = xml_tables.scan_files(spark, str(tmp_path / "a.xml"), "A", T.StructType.fromDDL("X long, Y string"))
    pieces = [piece for piece in text.split("<A")[1:] if piece[:1] in (" ", "\t", "\n", "/", ">") and piece.strip()]
    parsed = [ElementTree.fromstring(re.match(r"""(?:[^>"']|"[^"]*"|'[^']*')*?/?>""", f"<A{piece}")[0].rstrip("/>") + "/>") for piece in pieces]
    expected = [(e.get("X") and int(e.get("X")), e.get("Y") and e.get("Y").strip()) for e in parsed]
    assert [(row.X, row.Y) for row in found.collect()] == expected
    assert "Contains(value" in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text", ["<A X=\"1/>", "<A X=\"1\" Y='\"/>", "<A X=\"1\"", "<A X=\"1\" X=\"2\"/>", "<A X=\"1\" Y/>", "<A X=\"z\"/>"])
def test_lone_elements_that_are_malformed(spark, tmp_path, text):
    (tmp_path / "a.xml").write_text(text)
    with pytest.raises(Exception):
        xml_tables.scan_files(spark, str(tmp_path / "a.xml"), "A", T.StructType.fromDDL("X long, Y string")).collect()


def test_rooms_with_empty_parents_derive_the_hierarchy_once(spark):
    """The query reads the stored hierarchy: countries are left in the address objects alone."""
    df = plan_queries.queries()["mq14_all_rooms_keep_empty"](spark, SF_DIR)
    assert any("/hierarchy-" in file for file in df.inputFiles())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line and "n_nationkey#" in line for line in plan.splitlines()) == 1


def test_named_and_unnamed_apartments_read_the_same_links(stored):
    """Links have one filter wherever they are read, so that their shuffle is used again."""
    plan = wid.all_rooms(stored, keep_empty=True, ordered=False)._jdf.queryExecution().optimizedPlan().toString()
    filters = [re.sub(r"#\d+L?", "", line).lstrip(" :+-") for line in plan.splitlines() if "isnotnull(parentobjid#" in line]
    assert len(filters) >= 3 and len(set(filters)) == 1
