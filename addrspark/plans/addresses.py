"""Full addresses of objects, houses and apartments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from addrspark.functions.names import apartment_suffix, contains_text, house_suffix, or_not_found
from addrspark.operators.addresses import (
    address_key,
    bundle_of,
    bundled,
    bundle_parts,
    joined,
    nearest_parts,
    parts_aggregate,
    paths_of_bundles,
    place_steps,
)
from addrspark.operators.joins import join_splitting
from addrspark.operators.ranking import ascending, listed
from addrspark.registry import Registry
from addrspark.shared import materialize

HOUSE_KEYS = ["objectid", "housenum", "addnum1", "addnum2"]


def limited_to(df: DataFrame, ids: DataFrame | list[int] | None, column: str = "objectid") -> DataFrame:
    """Rows of the given ids: a list is pushed to the scan, a table semi-joined."""
    if ids is None:
        return df
    if isinstance(ids, list):
        return df.where(F.col(column).isin(ids))
    return df.join(ids.select(F.col("objectid").alias(column)), column, "left_semi")


def house_bundles(reg: Registry, ids: DataFrame | list[int] | None = None, keys: list[str] = HOUSE_KEYS) -> DataFrame:
    """Actual houses with the bundle of their own paths.

    The joins and the grouping all work on ``objectid``: one shuffle per table.
    """
    rows = limited_to(reg.houses, ids).select(*keys).join(reg.hierarchy.select("objectid", "path"), "objectid")
    return bundled(address_key(rows, reg.places), keys, "key_path", reg.single_rows)


def addresses(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """Address of each object with an active path and a known address object in it."""
    rows = limited_to(reg.hierarchy.select("objectid", "path"), ids)
    bundles = bundled(address_key(rows, reg.places), ["objectid"], "key_path", reg.single_rows)
    parts = nearest_parts(paths_of_bundles(bundles), reg.places)
    return join_splitting(bundles, parts, "bundle").select(
        F.col("objectid").alias("target_objectid"), joined().alias("full_address")
    )


def address_line(reg: Registry, objectid: int) -> DataFrame:
    """One row with the address of one object; NULL if there is none."""
    steps = place_steps(reg.hierarchy.where(F.col("objectid") == objectid).select("path"), reg.places)
    return steps.agg(parts_aggregate()).select(joined().alias("full_address"))


def houses_with_addresses(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """All actual houses with the address of their place and their full address."""
    bundles = house_bundles(reg, ids)
    parts = bundle_parts(paths_of_bundles(bundles), reg.places, single_path=reg.single_rows)
    place = joined()
    return join_splitting(bundles, parts, "bundle").select(
        F.col("objectid").alias("house_objectid"),
        "housenum",
        "addnum1",
        "addnum2",
        place.alias("address_without_house"),
        F.concat(place, house_suffix()).alias("full_address"),
    )


def house_addresses(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """House id, number and full address."""
    return houses_with_addresses(reg, ids).select("house_objectid", "housenum", "full_address")


def apartment_addresses(reg: Registry, ids: DataFrame | list[int] | None = None) -> DataFrame:
    """Full address of actual apartments of actual houses.

    The hierarchy row of the apartment may be inactive; that of the house may not.
    """
    apartments = limited_to(reg.apartments, ids).select(F.col("objectid").alias("apartment_objectid"), "number")
    links = reg.table("mun_hierarchy").select(
        F.col("objectid").alias("apartment_objectid"), F.col("parentobjid").alias("objectid")
    )
    keys = ["apartment_objectid", "number", "housenum", "addnum1", "addnum2"]
    rows = apartments.join(links, "apartment_objectid")
    # Of some apartments only the houses above them are read.
    houses = house_bundles(reg) if ids is None else house_bundles(reg, rows.select("objectid").distinct())
    bundles = (
        join_splitting(rows, houses, "objectid")
        .groupBy(*keys)
        .agg(bundle_of("bundle"))
    )
    parts = bundle_parts(paths_of_bundles(bundles), reg.places)
    return join_splitting(bundles, parts, "bundle").select(
        "apartment_objectid",
        F.col("number").alias("apartment_number"),
        F.concat(joined(), house_suffix(), apartment_suffix("number", required=True)).alias("full_address"),
    )


def _with_parts(picked: DataFrame, reg: Registry) -> DataFrame:
    """Left-join the parts of the one path in ``key_path``."""
    bundles = picked.withColumnRenamed("key_path", "bundle")
    parts = bundle_parts(paths_of_bundles(bundles.where("bundle is not null")), reg.places, single_path=True)
    return join_splitting(bundles, parts, "bundle", "left")


def full_address(reg: Registry, ids: DataFrame) -> DataFrame:
    """Address of each requested id, or the default text.

    Of several active paths the lowest is taken.
    """
    ids = ids.select("objectid")
    paths = limited_to(reg.hierarchy.select("objectid", "path"), ids).groupBy("objectid").agg(F.min("path").alias("path"))
    picked = ids.join(address_key(paths, reg.places), "objectid", "left")
    return _with_parts(picked, reg).select("objectid", or_not_found(joined()).alias("full_address"))


def house_address(reg: Registry, ids: DataFrame) -> DataFrame:
    """Address with house number of each requested id, or the default text."""
    ids = ids.select("objectid")
    rows = (
        limited_to(reg.houses, ids)
        .select(*HOUSE_KEYS)
        .join(reg.hierarchy.select("objectid", "path").where("path is not null"), "objectid")
        .groupBy("objectid")
        .agg(F.min(F.struct("path", "housenum", "addnum1", "addnum2")).alias("row"))
        .select("objectid", "row.*")
    )
    picked = ids.join(address_key(rows, reg.places), "objectid", "left")
    address = F.concat(joined(), house_suffix())
    return _with_parts(picked, reg).select("objectid", or_not_found(address).alias("full_address"))


def on_street(reg: Registry, street: Column) -> DataFrame:
    """Actual houses whose parent is an address object matching ``street``.

    The matching streets are few in a search; then they and their house ids are
    broadcast after counting, and the hierarchy is scanned without a shuffle.
    """
    streets = reg.places.where(street).select(
        F.col("objectid").alias("street_objectid"), F.col("name").alias("street_name"),
        F.col("typename").alias("street_type"),
    )
    children = reg.hierarchy.withColumnRenamed("parentobjid", "street_objectid")
    rows = children.join(streets, "street_objectid")
    return reg.houses.join(rows, "objectid")


def houses_on_street(reg: Registry, name: str | None = None, typename: str | None = None) -> DataFrame:
    """Houses of a street (or of all) with the distinct names of the places above it (levels to 6)."""
    match = F.col("level") == "8"
    if name is not None:
        match = match & (F.col("name") == name)
    if typename is not None:
        match = match & (F.col("typename") == typename)
    keys = [*HOUSE_KEYS, "street_name", "street_type"]
    rows = address_key(on_street(reg, match), reg.places.where("level_num <= 6"))
    bundles = bundled(rows, keys, "key_path", False)
    above = place_steps(paths_of_bundles(bundles), reg.places.where("level_num <= 6"))
    names = above.groupBy("bundle").agg(F.array_sort(F.collect_set("label")).alias("names"))
    rows = join_splitting(bundles, names, "bundle").select(
        F.col("objectid").alias("house_objectid"), "housenum", "addnum1", "addnum2", "street_name", "street_type",
        joined("names").alias("parent_address"),
    )
    return listed(rows, None if name is None else [name], "housenum", "house_objectid")


def find_houses(reg: Registry, street_part: str, housenum: str, limit: int = 10) -> DataFrame:
    """Houses by part of the street name and the number, with their addresses."""
    match = contains_text("name", street_part) & (F.col("level") == "8")
    found = on_street(reg, match).where(F.col("housenum") == housenum)
    found = found.select("objectid").orderBy(*ascending("objectid")).limit(limit)
    return _addressed(reg, found)


def houses_of_named_street(reg: Registry, name: str, typename: str, limit: int = 10) -> DataFrame:
    """First houses of an exactly named street, with their addresses."""
    match = (F.col("name") == name) & (F.col("typename") == typename) & (F.col("level") == "8")
    found = on_street(reg, match).select("objectid", "housenum").orderBy(*ascending("housenum", "objectid")).limit(limit)
    result = _addressed(reg, found).withColumnRenamed("objectid", "house_objectid")
    return result.select("house_objectid", "housenum", "full_address").orderBy(*ascending("housenum", "house_objectid"))


def _addressed(reg: Registry, found: DataFrame) -> DataFrame:
    """With the address of each; ``found`` is a search's few rows, stored so that the search runs once."""
    found = materialize(found, "found")
    address = house_address(reg, found.select("objectid").distinct())
    return found.join(address, "objectid")


def search_view(reg: Registry, place_part: str, limit: int = 10) -> DataFrame:
    """First rows of the house view whose place address contains a text."""
    view = houses_with_addresses(reg).where(contains_text("address_without_house", place_part))
    return view.orderBy(*ascending("housenum", "house_objectid")).limit(limit)


def search_full_address(reg: Registry, parts: list[str], limit: int = 5) -> DataFrame:
    """First rows of the house view whose full address contains all the texts."""
    view = houses_with_addresses(reg)
    for part in parts:
        view = view.where(contains_text("full_address", part))
    return view.orderBy(*ascending("housenum", "house_objectid")).limit(limit).select("house_objectid", "full_address")
