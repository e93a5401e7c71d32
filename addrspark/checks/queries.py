"""The registered queries: each over the whole registry tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from addrspark.fixtures import REGISTRY_TABLES, derived_registry
from addrspark.operators.search_index import TextIndex
from addrspark.plans import addresses as adr, hierarchy as hie, houses as hou, statistics as sta, wide as wid
from addrspark.plans.search import AddressIndex
from addrspark.plans.subtrees import SubtreeIndex
from addrspark.registry import Registry
from addrspark.shared import new_folder
from addrspark.sinks.write import load_registry

Query = Callable[[SparkSession, str], DataFrame]

# Searched names: the fixtures' streets carry customer names.
STREET, STREET_TYPE = "Customer#000000052", "building"
STREET_PART = "customer#00000005"


def over_registry(query: Callable[[Registry], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(derived_registry(spark, sf_dir))


def over_stored_hierarchy(query: Callable[[Registry], DataFrame]) -> Query:
    """As ``over_registry``, with the hierarchy derived once and stored, for a query that reads it many times."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg, folder = derived_registry(spark, sf_dir), new_folder(spark, "hierarchy")
        hierarchy = reg.table("mun_hierarchy")
        hierarchy.write.option("compression", "zstd").parquet(folder)
        stored = spark.read.schema(hierarchy.schema).parquet(folder)
        return query(Registry(reg.tables | {"mun_hierarchy": stored}))
    return run


def wanted(spark: SparkSession, sf_dir: str, reg: Registry, tables: list[str]) -> DataFrame:
    """Ids of the tables, and ids that no table has."""
    ids = spark.read.parquet(f"{sf_dir}/part.parquet").select((F.col("p_partkey") + 20000000).alias("objectid"))
    for name in tables:
        ids = ids.union(reg.table(name).select("objectid"))
    return ids.distinct()


def full_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = derived_registry(spark, sf_dir)
    return adr.full_address(reg, wanted(spark, sf_dir, reg, ["addr_obj", "steads"]))


def house_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = derived_registry(spark, sf_dir)
    return adr.house_address(reg, wanted(spark, sf_dir, reg, ["houses"]))


def addresses() -> dict[str, Query]:
    return {
        "aq2_addresses": over_registry(adr.addresses),
        "aq3_house_addresses": over_registry(adr.house_addresses),
        "aq4_apartment_addresses": over_registry(adr.apartment_addresses),
        "aq5_houses_on_street": over_registry(lambda reg: adr.houses_on_street(reg, STREET, STREET_TYPE)),
        "aq5_houses_on_all_streets": over_registry(adr.houses_on_street),
        "aq6_full_address": full_address,
        "aq7_house_address": house_address,
        "aq8_houses_with_addresses": over_registry(adr.houses_with_addresses),
        "aq9_find_houses": over_registry(lambda reg: adr.find_houses(reg, STREET_PART, "45")),
        "at4_search_view": over_registry(lambda reg: adr.search_view(reg, "Customer#00000005")),
        "at5_search_full_address": over_registry(lambda reg: adr.search_full_address(reg, ["asia", STREET_PART])),
        "at6_houses_of_named_street": over_registry(lambda reg: adr.houses_of_named_street(reg, STREET, STREET_TYPE)),
    }


def roots(reg: Registry) -> DataFrame:
    return reg.hierarchy.where("parentobjid is null").select("objectid")


def regions(reg: Registry) -> DataFrame:
    return reg.places.where("level_num = 1").select("objectid")


def hierarchy() -> dict[str, Query]:
    return {
        "aq1_address_chain": over_registry(hie.address_chain),
        "mq1_object_card": over_registry(hie.object_card),
        "mq2_ancestors_of_roots": over_registry(lambda reg: hie.ancestors(reg, roots(reg))),
        "mq4_numbered_children": over_registry(hie.numbered_children),
        "mq4_numbered_children_of_one": over_registry(lambda reg: hie.numbered_children(reg, parent=1)),
        "mq5a_subtree_to_level_6": over_registry(lambda reg: hie.subtree(reg, regions(reg), max_level=6)),
        "mq5b_subtree_of_one": over_registry(lambda reg: hie.subtree(reg, [1], limit=100)),
        "mq6_ancestors": over_registry(hie.ancestors),
        "mq7_address_line": over_registry(lambda reg: adr.address_line(reg, 1000052)),
        "mq7_address_line_of_none": over_registry(lambda reg: adr.address_line(reg, 20000000)),
        "mq8_objects_under": over_registry(lambda reg: hie.objects_under(reg, "1")),
        "mq8_objects_to_level_8": over_registry(lambda reg: hie.objects_under(reg, None, max_level=8)),
        "mq8_objects_of_level_3": over_registry(lambda reg: hie.objects_under(reg, None, min_level=3, max_level=3)),
        "mq8_objects_under_strict": over_registry(lambda reg: hie.objects_under(reg, "1", max_level=8, strict=True)),
        "mq9_child_by_name": over_registry(lambda reg: hie.child_by_name(reg, 1, "A")),
        "mq10_settlements_below": over_registry(lambda reg: hie.settlements_below(reg, "8")),
        "j9_walk_down": over_registry(lambda reg: hie.subtree(reg, regions(reg))),
    }


def statistics() -> dict[str, Query]:
    return {
        "aq10_counts_by_level": over_registry(sta.counts_by_level),
        "mq3_level_counts": over_registry(lambda reg: sta.level_counts(reg, "1", max_level=6)),
        "mq3_level_counts_strict": over_registry(lambda reg: sta.level_counts(reg, "1", max_level=6, strict=True)),
        "mq3_level_counts_by_root": over_registry(lambda reg: sta.level_counts_by_root(reg, max_level=6)),
        "mq5c_level_counts_of_district": over_registry(lambda reg: sta.level_counts(reg, "1.100")),
        "mq11a_house_count": over_registry(lambda reg: sta.house_count(reg, "1")),
        "mq11a_house_count_strict": over_registry(lambda reg: sta.house_count(reg, "1", strict=True)),
        "mq11a_house_counts_by_root": over_registry(sta.house_counts_by_root),
        "mq11c_house_count_of_district": over_registry(lambda reg: sta.house_count(reg, "1.100")),
        "mq11d_statistics_of_district": over_registry(lambda reg: sta.full_statistics(reg, "1.100")),
        "mq11d_statistics": over_registry(sta.full_statistics),
    }


def houses() -> dict[str, Query]:
    return {
        "mq11b_houses_of_streets": over_registry(hou.houses_of_streets),
        "mq11e_house_by_address": over_registry(lambda reg: hou.house_by_address(reg, STREET, STREET_TYPE, "45")),
        "mq11f_actual_house_addresses": over_registry(hou.actual_house_addresses),
        "mq11g_addresses_through_parent": over_registry(hou.addresses_through_parent),
    }


def wide() -> dict[str, Query]:
    return {
        "mq12_all_houses": over_registry(wid.all_houses),
        "mq12_all_houses_under": over_registry(lambda reg: wid.all_houses(reg, "1")),
        "mq13_all_apartments": over_registry(wid.all_apartments),
        "mq13_all_apartments_keep_empty": over_registry(lambda reg: wid.all_apartments(reg, keep_empty=True)),
        "mq14_all_rooms": over_registry(wid.all_rooms),
        "mq14_all_rooms_keep_empty": over_stored_hierarchy(lambda reg: wid.all_rooms(reg, keep_empty=True)),
    }


def indexed(query: Callable[[AddressIndex, Registry], DataFrame]) -> Query:
    """A search through indexes of the whole registry, built for it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg = derived_registry(spark, sf_dir)
        return query(AddressIndex.build(reg, new_folder(spark, "index"), buckets=16), reg)

    return run


def documents_with(*parts: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
        return TextIndex.build(documents, "text", new_folder(spark, "index"), buckets=16).search(*parts).select("doc_id")

    return run


def labelled(query: Callable[[SubtreeIndex, Registry], DataFrame]) -> Query:
    """Subtrees through labels of the whole registry, made for it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg = derived_registry(spark, sf_dir)
        return query(SubtreeIndex.build(reg, new_folder(spark, "subtrees")), reg)

    return run


def region_list(reg: Registry) -> list[int]:
    return [row.objectid for row in regions(reg).collect()]


def searches() -> dict[str, Query]:
    return {
        "mq5a_subtree_labelled": labelled(lambda index, reg: index.subtree(region_list(reg), max_level=6)),
        "mq5b_subtree_labelled": labelled(lambda index, _: index.subtree([1], limit=100)),
        "aq9_find_houses_indexed": indexed(lambda index, reg: index.find_houses(reg, STREET_PART, "45")),
        "at4_search_view_indexed": indexed(lambda index, _: index.search_view("Customer#00000005")),
        "at5_search_full_address_indexed": indexed(lambda index, _: index.search_full_address(["asia", STREET_PART])),
        "at5_search_house_part_indexed": indexed(lambda index, _: index.search_full_address(["asia", "5, д. 45"], limit=1000)),
        "mq9_child_by_name_indexed": indexed(lambda index, reg: index.child_by_name(reg, 1, "A")),
        "e12_indexed": documents_with("eauÉ", "la"),
        "e12_indexed_short_part": documents_with("ç"),
    }


_loaded: dict[tuple[str, str], str] = {}


def loaded(spark: SparkSession, sf_dir: str) -> str:
    """The tables loaded and checked once per session: clustered parquet, index of paths, mark of the check."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        base = new_folder(spark, "registry")
        load_registry(derived_registry(spark, sf_dir).tables, base)
        Registry.from_parquet(spark, base, REGISTRY_TABLES).verified()
        _loaded[key] = base
    return _loaded[key]


def over_verified(query: Callable[[Registry], DataFrame]) -> Query:
    """The query on the loaded tables, where the mark says that no object has several rows."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reg = Registry.from_parquet(spark, loaded(spark, sf_dir), REGISTRY_TABLES)
        if not reg.single_rows:
            raise ValueError("the mark of the check was not found")
        return query(reg)

    return run


#: The queries that leave groupings out on a verified registry.
ON_VERIFIED = {
    "aq2_addresses": adr.addresses,
    "aq4_apartment_addresses": adr.apartment_addresses,
    "aq8_houses_with_addresses": adr.houses_with_addresses,
    "mq11g_addresses_through_parent": hou.addresses_through_parent,
    "mq12_all_houses": wid.all_houses,
    "mq13_all_apartments": wid.all_apartments,
    "mq14_all_rooms": wid.all_rooms,
}


def verified() -> dict[str, Query]:
    return {f"{key}_verified": over_verified(query) for key, query in ON_VERIFIED.items()}


def queries() -> dict[str, Query]:
    return verified() | searches() | addresses() | hierarchy() | statistics() | houses() | wide()
