"""Lists and addresses of houses by their street."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from addrspark.functions.names import house_suffix, house_type_name
from addrspark.operators.addresses import bundle_parts, bundled, joined, paths_of_parents
from addrspark.operators.joins import join_splitting
from addrspark.operators.ranking import first_per_group, listed
from addrspark.plans.addresses import HOUSE_KEYS, house_address, limited_to, on_street
from addrspark.registry import Registry


def houses_of_streets(reg: Registry, streets: list[int] | None = None, limit: int = 20) -> DataFrame:
    """The first houses by number of each street, with the house type in words."""
    hierarchy = limited_to(reg.hierarchy, streets, "parentobjid").select("objectid", "parentobjid")
    rows = reg.houses.join(hierarchy, "objectid").where("parentobjid is not null")
    first = first_per_group(rows, ["parentobjid"], ["housenum", "objectid"], limit)
    rows = first.select(
        F.col("parentobjid").alias("street_objectid"), *HOUSE_KEYS, "housetype",
        house_type_name("housetype").alias("housetype_name"),
    )
    return listed(rows, streets, "street_objectid", "housenum", "objectid")


def house_by_address(reg: Registry, street: str, street_type: str, housenum: str) -> DataFrame:
    """Houses by exact street name, street type and number."""
    match = (F.col("name") == street) & (F.col("typename") == street_type)
    rows = on_street(reg, match).where(F.col("housenum") == housenum)
    return rows.select(*HOUSE_KEYS, "housetype", "street_name", "street_type")


def actual_house_addresses(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """Address of each actual house, with the default text where there is none."""
    return house_address(reg, limited_to(reg.houses, ids))


def addresses_through_parent(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """House addresses read from the path of the parent, not of the house."""
    rows = limited_to(reg.houses, ids).select(*HOUSE_KEYS).join(
        reg.hierarchy.select("objectid", "parentobjid"), "objectid"
    )
    bundles = bundled(rows, HOUSE_KEYS, "parentobjid", reg.single_rows)
    parts = bundle_parts(paths_of_parents(bundles, reg.hierarchy), reg.places, single_path=reg.single_rows)
    return join_splitting(bundles, parts, "bundle").select(
        F.col("objectid").alias("house_objectid"),
        F.concat(joined(), house_suffix()).alias("full_address_level_1_to_10"),
    )
