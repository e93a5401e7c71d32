"""Documented results and the special cases of addresses."""

import pytest
from rows import house, link, place
from pyspark.sql import functions as F

from addrspark.functions.names import NOT_FOUND
from addrspark.plans import addresses as adr, hierarchy as hie, houses as hou, statistics as sta, wide as wid
from addrspark.registry import Registry

ARBAT = "г Москва, вн.тер.г. муниципальный округ Арбат, ул Арбат"


def as_dict(df, key, value):
    return {row[key]: row[value] for row in df.collect()}


def test_address_of_root_and_street(moscow):
    found = as_dict(adr.addresses(moscow), "target_objectid", "full_address")
    assert found[1405113] == "г Москва"
    assert found[1447085] == ARBAT
    assert found[67054556] == ARBAT
    assert adr.address_line(moscow, 1447085).collect()[0][0] == ARBAT
    assert adr.address_line(moscow, 42).collect()[0][0] is None


def test_house_addresses(moscow):
    found = as_dict(adr.houses_with_addresses(moscow), "house_objectid", "full_address")
    assert found == {
        67054556: ARBAT + ", д. 10",
        67054557: ARBAT + ", д. 12 корп. 1 стр. 2",
        67054558: None,
        # The street is not actual: it vanishes from the address.
        5: "г Москва, вн.тер.г. городской округ Троицк, д. 1",
    }


def test_ids_as_list_and_table(spark, moscow):
    ids = spark.createDataFrame([(67054556,)], "objectid long")
    assert adr.houses_with_addresses(moscow, [67054556]).collect() == adr.houses_with_addresses(moscow, ids).collect()
    assert adr.houses_with_addresses(moscow, ids).count() == 1


def test_default_text(spark, moscow):
    ids = spark.createDataFrame([(67054556,), (67054558,), (42,)], "objectid long")
    assert as_dict(adr.house_address(moscow, ids), "objectid", "full_address") == {
        67054556: ARBAT + ", д. 10", 67054558: NOT_FOUND, 42: NOT_FOUND
    }
    assert as_dict(adr.full_address(moscow, ids), "objectid", "full_address") == {
        67054556: ARBAT, 67054558: ARBAT, 42: NOT_FOUND
    }


def test_house_type_and_first_houses(moscow):
    rows = hou.houses_of_streets(moscow, [1447085]).collect()
    assert [row["housenum"] for row in rows] == ["10", "12", None]
    assert [row["housetype_name"] for row in rows] == ["Домовладение", "Другое", "Домовладение"]


def test_indented_subtree(moscow):
    rows = hie.subtree(moscow, [95251365]).collect()
    assert [row["name_indented"] for row in rows] == ["городской округ Троицк", "  Троицк"]


def test_ancestors_and_chain(moscow):
    rows = hie.ancestors(moscow, [1447085]).collect()
    assert [(row["position"], row["display_name"]) for row in rows] == [
        (1, "г Москва"), (2, "вн.тер.г. муниципальный округ Арбат"), (3, "ул Арбат")
    ]
    chain = hie.address_chain(moscow, [1447085]).collect()
    assert [row["depth"] for row in chain] == [3, 2, 1]
    assert {row["full_address"] for row in chain} == {ARBAT}


def test_prefix_by_text_and_by_step(make_registry):
    reg = make_registry(
        addr_obj=[place(1, "a", "t", 1), place(15, "b", "t", 1)],
        mun_hierarchy=[link("1"), link("15"), link("1.7"), link("15.8")],
        houses=[house(7, "1"), house(8, "1")],
        object_levels=[(1, "one")],
    )
    assert sta.house_count(reg, "1").collect()[0][0] == 2
    assert sta.house_count(reg, "1", strict=True).collect()[0][0] == 1


def test_cycle_is_an_error(make_registry):
    reg = make_registry(
        addr_obj=[place(1, "a", "t", 1), place(2, "b", "t", 3)],
        mun_hierarchy=[(1, 2, "2.1", 1), (2, 1, "1.2", 1)],
    )
    with pytest.raises(ValueError, match="cycle"):
        hie.subtree(reg, [1])


def test_long_chains_are_no_cycles(make_registry):
    ids = range(1, 8)
    reg = make_registry(
        addr_obj=[place(i, f"n{i}", "t", i) for i in ids],
        mun_hierarchy=[(i, i - 1 or None, ".".join(map(str, range(1, i + 1))), 1) for i in ids],
    )
    assert sorted(row["objectid"] for row in hie.subtree(reg, [1]).collect()) == list(ids)


def plain_steps(reg, rows, keys, path="path"):
    """The parts of an address by expanding each row by itself."""
    steps = rows.select(*keys, F.col(path).alias("p"), F.posexplode(F.split(path, "[.]")).alias("pos", "step")).withColumn(
        "objectid_", F.col("step").cast("bigint")
    )
    named = steps.join(reg.places.withColumnRenamed("objectid", "objectid_"), "objectid_")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "p", "label")))
    return named.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["label"]), ", ").alias("address"))


@pytest.fixture(scope="module")
def messy(make_registry):
    """Rows loaded twice, several active paths, an id in two tables, dead parents."""
    return make_registry(
        addr_obj=[
            place(1, "R", "reg", 1), place(2, "D", "d", 3), place(3, "S", "st", 8), place(4, "T", "", 8),
            place(5, "U", None, 8), place(5, "U2", "st", 8), place(70, "Both", "st", 8), place(6, None, "st", 8),
        ],
        mun_hierarchy=[
            link("1"), link("1.2"), link("1.2.3"), link("1.2.4"), link("1.5"), link("1.2.6"), link("1.2.9"),
            link("1.2.3.60"), link("1.2.3.61"), link("1.2.4.61"), link("1.2.3.62"), link("1.2.3.62"),
            link("1.5.63"), link("1.2.9.64"), link("1.2.3.70"), link("65"), link("1.2.6.66"),
            (67, 3, "1.2.3", 1), (68, None, None, 1), link("1.2.3.69", active=0),
            link("1.2.3.60.80"), link("1.2.3.60.81"), link("1.2.3.60.81"), link("1.2.3.61.82"), link("1.2.4.61.82"),
            link("1.2.3.60.80.90"), link("1.2.3.60.81.91"), link("1.2.3.60.81.92", active=0), link("1.2.3.60.99"),
            link("1.2.3.60.98"), link("1.2.3.62.83", active=0),
        ],
        houses=[
            house(60, "1"), house(61, "2"), house(62, "3"), house(62, "3"), house(63, "4"), house(64, "5"),
            house(70, "6"), house(65, "7"), house(66, "8"), house(67, "9"), house(68, "10"), house(69, "11"),
            house(60, "1bis"), house(71, "none"),
        ],
        apartments=[(n, f"a{n}", str(n), 2, 1) for n in (80, 81, 82, 83)] + [(84, "a84", "84", 2, 0)],
        rooms=[(n, f"m{n}", None if n == 91 else str(n), 1, 1) for n in (90, 91, 92)],
    )


def same(left, right):
    columns = sorted(left.columns)
    left, right = left.select(*columns), right.select(*columns)
    assert left.exceptAll(right).collect() == []
    assert right.exceptAll(left).collect() == []


HOUSE = ["objectid", "housenum", "addnum1", "addnum2"]


def test_shared_parts_equal_plain_expansion(messy):
    rows = messy.houses.select(*HOUSE).join(messy.hierarchy, "objectid")
    plain = plain_steps(messy, rows, HOUSE)
    fast = adr.houses_with_addresses(messy).select(
        F.col("house_objectid").alias("objectid"), "housenum", "addnum1", "addnum2",
        F.coalesce("address_without_house", F.lit("")).alias("address"),
    )
    same(fast, plain)
    found = [row["address"] for row in plain.where("objectid = 61").collect()]
    assert found == ["reg R, reg R, d D, d D, st S, T"]


def test_shared_parts_through_parent_equal_plain_expansion(messy):
    up = messy.hierarchy.select(F.col("objectid").alias("parentobjid"), F.col("path").alias("up"))
    rows = messy.houses.select(*HOUSE).join(messy.hierarchy, "objectid").join(up, "parentobjid")
    plain = plain_steps(messy, rows, HOUSE, "up").select(
        F.col("objectid").alias("house_objectid"),
        F.concat("address", F.lit(", д. "), "housenum").alias("full_address_level_1_to_10"),
    )
    same(hou.addresses_through_parent(messy), plain)


def test_apartments_equal_plain_expansion(messy):
    own = messy.table("mun_hierarchy").select("objectid", F.col("parentobjid").alias("up"))
    houses = messy.houses.select(F.col("objectid").alias("up"), "housenum", "addnum1", "addnum2").join(
        messy.hierarchy.select(F.col("objectid").alias("up"), "path"), "up"
    )
    keys = ["objectid", "number", "housenum", "addnum1", "addnum2"]
    plain = plain_steps(messy, messy.apartments.join(own, "objectid").join(houses, "up"), keys).select(
        F.col("objectid").alias("apartment_objectid"), F.col("number").alias("apartment_number"),
        F.concat("address", F.lit(", д. "), "housenum", F.lit(", кв. "), "number").alias("full_address"),
    )
    same(adr.apartment_addresses(messy), plain)


@pytest.mark.parametrize("keep_empty", [False, True])
def test_wide_rooms_equal_plain_expansion(messy, keep_empty):
    """Joined outwards from the houses, each row expanded by itself."""
    links = messy.hierarchy
    up = links.select(F.col("objectid").alias("parentobjid"), F.col("path").alias("up"))
    rows = messy.houses.join(links.select("objectid", "parentobjid"), "objectid").join(up, "parentobjid").select(
        F.col("objectid").alias("h"), "housenum", "up"
    )
    for kind, above, name in [("apartments", "h", "a"), ("rooms", "a", "m")]:
        child = links.select(F.col("parentobjid").alias(above), F.col("objectid").alias("child"))
        objects = getattr(messy, kind).select(F.col("objectid").alias("child"), F.col("number").alias(f"{name}_number"))
        objects = objects.withColumn(name, F.col("child"))
        rows = rows.join(child, above, "left").join(objects, "child", "left").drop("child")
    if not keep_empty:
        rows = rows.where("m is not null")
    keys = ["h", "housenum", "a", "a_number", "m", "m_number"]
    plain = plain_steps(messy, rows, keys, "up").select(
        F.col("h").alias("level_10_objectid"), F.col("a").alias("level_9_objectid"), F.col("m").alias("level_65_objectid"),
        F.concat(
            "address", F.lit(", д. "), "housenum", F.coalesce(F.concat(F.lit(", кв. "), "a_number"), F.lit("")),
            F.coalesce(F.concat(F.lit(", пом. "), "m_number"), F.lit("")),
        ).alias("full_address"),
    )
    wide = wid.all_rooms(messy, keep_empty=keep_empty)
    fast = wide.select("level_10_objectid", "level_9_objectid", "level_65_objectid", "full_address")
    missing = F.coalesce("full_address", F.lit("")) != ""
    same(fast.where(missing), plain.where(missing))
    assert wide.count() == plain.count()


def test_repeated_rows_are_found(messy, moscow):
    assert not messy.verified().single_rows
    assert moscow.verified().single_rows


@pytest.mark.parametrize("query", [
    adr.addresses, adr.houses_with_addresses, adr.apartment_addresses, hou.addresses_through_parent, wid.all_houses,
    wid.all_apartments, wid.all_rooms, lambda reg: wid.all_rooms(reg, keep_empty=True),
])
def test_single_rows_give_the_same(stored, query):
    checked = Registry(stored.tables, single_rows=True)
    same(query(checked), query(stored))


def test_derived_registry_has_single_rows(stored):
    assert stored.verified().single_rows


def test_addresses_are_taken_apart_once_per_place(stored):
    """Apartments and rooms do not add paths of their own."""
    from addrspark.operators.addresses import address_key, bundled, paths_of_bundles, place_paths

    rows = address_key(stored.hierarchy.select("objectid", "path"), stored.places)
    paths = paths_of_bundles(bundled(rows, ["objectid"], "key_path", False))
    places = stored.hierarchy.join(stored.places.select("objectid"), "objectid").select("path").distinct().count()
    found = place_paths(paths.where("bundle = path"), stored.places).select("place_path").distinct().count()
    assert found < 2 * places < paths.count() / 5
