"""Shapes of the plans: what reaches the scan, what is shuffled, how skew is met."""

import pytest
from pyspark.sql import Window, functions as F

from addrspark.operators.ranking import numbered
from addrspark.plans import addresses as adr, houses as hou, statistics as sta, wide as wid
from addrspark.registry import Registry
from addrspark.shared import materialize
from addrspark.sinks.write import load_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_broadcast(spark, make):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_prefix_and_flags_reach_the_scan(stored):
    text = plan(sta.house_count(stored, "1.100"))
    assert "StringStartsWith(path,1.100)" in text
    assert "EqualTo(isactive,1)" in text and "EqualTo(isactual,1)" in text
    assert "ReadSchema: struct<objectid:bigint,isactual:int>" in text


def test_prefix_skips_row_groups(spark, stored, tmp_path):
    """Hierarchy files are sorted by path, so their statistics separate the prefixes."""
    load_table(stored.table("mun_hierarchy"), str(tmp_path / "h"))
    rows = spark.read.parquet(str(tmp_path / "h")).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "path")
    unsorted = rows.groupBy("f").agg(F.array_sort(F.collect_list(F.struct("i", "path"))).alias("rows")).selectExpr(
        "transform(rows, r -> r.path) as paths").where("paths <> array_sort(paths)")
    assert unsorted.count() == 0


def test_id_list_reaches_both_scans(stored):
    text = plan(adr.houses_with_addresses(stored, [100000001]))
    assert text.count("PushedFilters: [IsNotNull(isactive), EqualTo(isactive,1), EqualTo(objectid,100000001)") >= 1 \
        or text.count("EqualTo(objectid,100000001)") >= 2


def test_house_view_shuffles_each_table_once(spark, stored):
    def run():
        df = adr.houses_with_addresses(stored)
        df.collect()
        return plan(df).split("== Initial Plan ==")[0]

    text = without_broadcast(spark, run)
    assert text.count("ReusedExchange") >= 3
    assert text.count("FileScan parquet") == 4  # houses, hierarchy, ids and names of places
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("make", [
    adr.addresses, adr.apartment_addresses, hou.addresses_through_parent, wid.all_houses, wid.all_rooms,
    sta.full_statistics, hou.houses_of_streets, adr.houses_on_street,
])
def test_no_python_and_no_products(stored, make):
    text = plan(make(stored))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_first_per_group_limits_before_the_shuffle(stored):
    assert "WindowGroupLimit" in plan(hou.houses_of_streets(stored))


def test_numbering_of_one_large_group(spark):
    df = spark.range(20000).selectExpr("if(id % 10 < 8, 1, id) as g", "string(id * 7919 % 20011) as name", "id")
    result = numbered(df, ["g"], ["name", "id"], "n")
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("name", "id")).cast("bigint"))
    assert result.exceptAll(expected.select(*result.columns)).count() == 0 and result.count() == 20000


def test_numbering_spreads_a_group(spark):
    """A group of all rows is numbered in many pieces; whole rows are shuffled once, and nothing is written."""
    df = spark.range(20000).selectExpr("1 as g", "id", "repeat('x', 100) as wide")
    result = numbered(df, ["g"], ["id"], "n")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = numbered(df, ["g"], ["id"], "n").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    whole = numbered(df, [], ["id"], "n").selectExpr("min(n)", "max(n)", "count(distinct n)").collect()[0]
    assert len(rows) > 1 and max(row["count"] for row in rows) < 15000
    assert tuple(whole) == (1, 20000, 20000)
    text = plan(result)
    assert "FileScan" not in text and text.count("Exchange hashpartitioning(g") <= 3


def test_numbering_of_all_kinds_of_keys(spark):
    df = spark.range(4000).selectExpr(
        "if(id % 5 = 0, null, id % 3) as g", "if(id % 7 = 0, null, string(id % 50)) as name", "array(id % 11, -id) as a",
        "if(id % 13 = 0, null, date_add(date'2020-01-01', int(id % 400))) as d", "id")
    result = numbered(df, ["g"], ["name", "d", "a", "id"], "n")
    order = [F.col(c).asc_nulls_last() for c in ("name", "d", "a", "id")]
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    assert result.exceptAll(expected.select(*result.columns)).count() == 0 and result.count() == 4000


def test_missing_values_are_numbered_last(spark):
    df = spark.createDataFrame([(None, "b"), (None, None), (1, "a"), (1, None)], "g int, name string")
    rows = {(r["g"], r["name"]): r["n"] for r in numbered(df, ["g"], ["name"], "n").collect()}
    assert rows == {(None, "b"): 1, (None, None): 2, (1, "a"): 1, (1, None): 2}


def test_materialized_table_lies_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(3), "test")
    assert df.count() == 3 and all(folder in path for path in df.inputFiles())


@pytest.fixture
def eager_splitting(spark):
    """Thresholds at which small test data counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot_registry(spark):
    """A third of the houses on one street, a third of the apartments in one house."""
    numbers = spark.range(60000)
    houses = numbers.where("id < 30000").selectExpr(
        "1000000 + id as objectid", "string(uuid()) as objectguid", "string(id % 300) as housenum",
        "string(null) as addnum1", "string(null) as addnum2", "1 as housetype", "1 as isactual",
        "if(id % 3 = 0, 10, 10 + id % 97) as street",
    )
    apartments = numbers.selectExpr(
        "9000000 + id as objectid", "string(uuid()) as objectguid", "string(id) as number", "1 as aparttype",
        "1 as isactual", "if(id % 3 = 0, 1000000, 1000000 + id div 2) as house",
    )
    links = houses.selectExpr(
        "objectid", "street as parentobjid", "concat('1.', street, '.', objectid) as path", "1 as isactive"
    ).union(apartments.selectExpr("objectid", "house", "concat('1.10.', house, '.', objectid)", "1")).union(
        numbers.where("id < 97").selectExpr("10 + id", "1L", "concat('1.', 10 + id)", "1"))
    streets = numbers.where("id < 97").selectExpr(
        "10 + id as objectid", "'g' as objectguid", "concat('S', id) as name", "'st' as typename", "'8' as level",
        "1 as isactual", "1 as isactive",
    )
    root = streets.limit(1).selectExpr("1L", "'g'", "'R'", "'reg'", "'1'", "1", "1")
    return Registry({
        "houses": houses.drop("street"), "apartments": apartments.drop("house"), "mun_hierarchy": links,
        "addr_obj": streets.union(root),
    })


def test_hot_street_is_split(hot_registry, eager_splitting):
    df = adr.houses_with_addresses(hot_registry)
    assert len(df.collect()) == 30000
    assert "skew=true" in plan(df)


def test_hot_house_is_split(hot_registry, eager_splitting):
    df = wid.all_apartments(hot_registry, ordered=False)
    assert len(df.collect()) == 60000
    assert plan(df).split("== Initial Plan ==")[0].count("skew=true") >= 2


def test_a_prefix_opens_the_files_that_hold_it(spark, stored, tmp_path):
    """A loaded hierarchy is clustered by path, a large region too; its index names the files for a prefix."""
    from addrspark.plans import hierarchy as hie
    from test_search import scans

    base = str(tmp_path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, df in stored.tables.items():
            load_table(df.withColumn("region", F.substring_index("path", ".", 1)) if name == "mun_hierarchy" else df, f"{base}/{name}")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    reg = Registry.from_parquet(spark, base, list(stored.tables))
    total = len(reg.table("mun_hierarchy").inputFiles())
    assert total >= 40
    for prefix in ("1.100", "8", "1", "1.100.1000100", "nothing", ""):
        rows = reg.hierarchy_under(prefix)
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, stored.hierarchy_under(prefix).collect()))
    (_, _, files), = scans(reg.hierarchy_under("1.100"))
    assert files <= 4
    assert reg.hierarchy_under("nothing").isEmpty()
    for call in (lambda r: sta.house_count(r, "1", strict=True), lambda r: sta.level_counts(r, "1.100"), lambda r: sta.full_statistics(r, "1.100"),
                 lambda r: hie.objects_under(r, "1"), lambda r: hie.settlements_below(r, "8")):
        assert sorted(map(str, call(reg).collect())) == sorted(map(str, call(stored).collect()))
    # Files that the index does not name: it is not used.
    stored.table("mun_hierarchy").where("path like '8%'").withColumn("region", F.lit("8")).limit(3).write.mode("append").partitionBy("region").parquet(
        f"{base}/mun_hierarchy")
    again = Registry.from_parquet(spark, base, list(stored.tables))
    assert again.hierarchy_under("8").count() == stored.hierarchy_under("8").count() + again.table("mun_hierarchy").where("isactive = 1").count() \
        - stored.hierarchy.count()
    load_table(again.table("mun_hierarchy"), f"{base}/mun_hierarchy_again", append=True)
    load_table(again.table("mun_hierarchy").limit(5), f"{base}/mun_hierarchy_again", append=True)
    assert spark.read.parquet(f"{base}/mun_hierarchy_again/_bounds").count() == len(spark.read.parquet(f"{base}/mun_hierarchy_again").inputFiles())
