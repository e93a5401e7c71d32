"""Exact lines of the text formats, layouts and loads."""

import os

import pytest

from addrspark.fixtures import REGISTRY_TABLES, derived_registry
from addrspark.operators import quality as qua
from addrspark.registry import Registry
from addrspark.sinks import render
from addrspark.plans import addresses as adr
from addrspark.sinks.write import load_bucketed, load_registry, load_table, write_dump
from addrspark.sources import files

SCHEMA = "id int, name string, day date, on boolean"
ROWS = [(1, 'a"b\\c\'d\te\r\nf', None, True), (None, "", None, False), (3, None, None, None)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("dialect, expected", [
    (render.CSV, ['"1","a\\"b\\\\c\'d\te\r\nf",\\N,1', '\\N,"",\\N,0', '"3",\\N,\\N,\\N']),
    (render.TSV, ['1\ta"b\\\\c\'d\\te\\r\\nf\t\\N\t1', '\\N\t\t\\N\t0', '3\t\\N\t\\N\t\\N']),
    (render.POSTGRES, ["\t('1', 'a\"b\\\\c\\'d\te\r\nf', NULL, '1')", "\t(NULL, '', NULL, '0')", "\t('3', NULL, NULL, NULL)"]),
    (render.MYSQL, ['\t("1", "a\\"b\\\\c\'d\te\r\nf", NULL, 1)', '\t(NULL, "", NULL, 0)', '\t("3", NULL, NULL, NULL)']),
])
def test_lines(rows, dialect, expected):
    assert [row["line"] for row in render.row_lines(rows, dialect).collect()] == expected


def test_insert_heads():
    assert render.insert_head("ADDR_OBJ", ["ID", "NAME"], render.POSTGRES) == 'INSERT INTO "addr_obj" ("id", "name") VALUES \n'
    assert render.insert_head("ADDR_OBJ", ["ID", "NAME"], render.MYSQL) == "INSERT INTO `ADDR_OBJ` (`ID`, `NAME`) VALUES \n"


def test_batches(spark):
    df = spark.range(1, 8).selectExpr("id", "if(id = 7, '2', '1') as region")
    rows = render.insert_statements(df, "T", render.POSTGRES, ["id"], ("region",), 4).orderBy("region", "batch").collect()
    head = 'INSERT INTO "t" ("id") VALUES \n'
    assert [(row["region"], row["batch"], row["statement"]) for row in rows] == [
        ("1", 0, head + "\t('1'),\n\t('2'),\n\t('3'),\n\t('4');\n"),
        ("1", 1, head + "\t('5'),\n\t('6');\n"),
        ("2", 0, head + "\t('7');\n"),
    ]


def test_plain_rows_need_a_file_per_table(rows, tmp_path):
    with pytest.raises(ValueError, match="region_tree"):
        write_dump({"T": rows}, str(tmp_path / "x"), "csv", "per_region")
    with pytest.raises(ValueError, match="unknown"):
        write_dump({"T": rows}, str(tmp_path / "x"), "xls", "direct")


def test_layout_folders(spark, tmp_path):
    df = spark.range(4).selectExpr("id", "string(id % 2) as region")
    for layout, expected in {
        "direct": [], "per_region": ["region=0", "region=1"], "per_table": ["table=HOUSES"],
        "region_tree": ["region=0/table=HOUSES", "region=1/table=HOUSES"],
    }.items():
        path = str(tmp_path / layout)
        write_dump({"HOUSES": df}, path, "psql", layout)
        found = {os.path.relpath(folder, path) for folder, _, names in os.walk(path) if any(n.endswith(".txt") for n in names)}
        assert sorted(found - {"."}) == expected


def test_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = spark.range(4).selectExpr("id", "'1' as region"), spark.range(2).selectExpr("id", "'2' as region")
    load_table(first, path)
    load_table(second, path)
    load_table(first, path)
    assert spark.read.parquet(path).count() == 6
    load_table(first, path, append=True)
    assert spark.read.parquet(path).count() == 10
    doubled = spark.read.parquet(path).withColumnRenamed("id", "objectid")
    assert [tuple(r) for r in qua.duplicate_objects(doubled, 2).collect()] == [(0, 3), (1, 3)]


def test_table_stats_with_sizes(spark, make_registry, tmp_path):
    (tmp_path / "77").mkdir()
    (tmp_path / "77" / "AS_HOUSES_1.XML").write_text("x" * 10)
    sizes = files.table_sizes(files.list_files(spark, str(tmp_path)))
    reg = make_registry(houses=[(1, "g", "1", None, None, 1, 1)])
    assert qua.largest_tables(reg, 1, sizes).collect()[0][:] == ("houses", 1, 10)


def test_expected_counts(make_registry):
    reg = make_registry(houses=[(i, "g", "1", None, None, 1, 1) for i in range(9)])
    reg = Registry({**reg.tables, "steads": reg.table("rooms")})

    def verdict(*arguments):
        return qua.check_expected(reg, *arguments).collect()[0][:]

    assert verdict(10) == (9, 10, 10.0, True)
    assert verdict(10, 0.09) == (9, 10, 10.0, False)
    assert verdict(0) == (9, 0, None, None)


def test_share_of_nothing(spark):
    reg = Registry({"normative_docs": spark.createDataFrame([], "id long, name string")})
    assert qua.missing_names(reg).collect()[0][:] == (0, 0, None)


def test_region_codes_stay_texts(spark, tmp_path):
    houses = spark.range(3).selectExpr("id as objectid", "string(id) as housenum", "1 as isactual", "'01' as region")
    load_registry({"houses": houses}, str(tmp_path))
    rows = Registry.from_parquet(spark, str(tmp_path), ["houses"]).houses.collect()
    assert {row["region"] for row in rows} == {"01"} and len(rows) == 3


def test_bucketed_tables_need_no_shuffle_by_object(spark, moscow, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        load_bucketed(moscow.tables, "bucketed", 4, str(tmp_path))
        reg = Registry.from_catalog(spark, "bucketed", list(moscow.tables))
        bundles = adr.house_bundles(reg)
        assert "Exchange hashpartitioning" not in bundles._jdf.queryExecution().executedPlan().toString()
        df = adr.houses_with_addresses(reg)
        assert sorted(df.collect(), key=str) == sorted(adr.houses_with_addresses(moscow).collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_a_load_makes_the_mark_of_a_check_void(spark, tmp_path):
    """Also one that adds rows or replaces them by the same; results go on to be right."""
    base, derived = str(tmp_path / "registry"), derived_registry(spark, "/root/testdata/sf0.001")
    load_registry(derived.tables, base)

    def stored():
        return Registry.from_parquet(spark, base, REGISTRY_TABLES)

    reg = stored()
    assert not reg.single_rows and reg.verified().single_rows
    assert stored().single_rows
    assert not Registry.from_parquet(spark, base, ["houses", "mun_hierarchy"]).single_rows
    load_table(derived.table("steads"), f"{base}/steads", append=True)
    assert stored().single_rows  # no table that is checked
    load_table(derived.table("houses").where("objectid % 10 = 1"), f"{base}/houses", append=True)
    assert not stored().single_rows
    again = reg.verified()  # opened before the load, counts the files that are there now
    assert not again.single_rows and not stored().single_rows
    plain = Registry(derived.tables | {"houses": derived.table("houses").union(derived.table("houses").where("objectid % 10 = 1"))})
    expected = adr.houses_with_addresses(plain)
    for found in (adr.houses_with_addresses(stored()), adr.houses_with_addresses(again)):
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    load_table(derived.table("houses"), f"{base}/houses")
    assert not stored().single_rows and stored().verified().single_rows
