"""Searches of places and houses by parts of names and addresses, through stored indexes.

Thousands of houses share the address of their place, so the indexed texts are the addresses of the places; the houses
are stored beside them by place. The part of a full address that is a house's own, from ``, д.`` on, is
compared house by house, on four narrow columns without a join. Only houses that may match get their address built and compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrspark.functions.names import HOUSE, contains_text, house_suffix
from addrspark.operators.addresses import bundle_parts, joined, paths_of_bundles
from addrspark.operators.ranking import ascending
from addrspark.operators.search_index import TextIndex, bucket_of, literal_pieces
from addrspark.plans.addresses import HOUSE_KEYS, _addressed, house_bundles
from addrspark.registry import Registry
from addrspark.shared import materialize


HOUSES = "bundle string, objectid long, housenum string, addnum1 string, addnum2 string, bucket int"


class AddressIndex:
    """Indexes below one folder: ``names`` of places, ``addresses`` of the places of houses, and the ``houses`` of each."""

    def __init__(self, spark: SparkSession, base: str):
        self.names, self.addresses = TextIndex(spark, f"{base}/names"), TextIndex(spark, f"{base}/addresses")
        self.houses = spark.read.schema(HOUSES).parquet(f"{base}/houses")

    @classmethod
    def build(cls, reg: Registry, base: str, buckets: int = 64) -> AddressIndex:
        """Index a registry; to be done after each load."""
        places = reg.places.select("objectid", "level", "typename", "name")
        TextIndex.build(places, "name", f"{base}/names", buckets)
        bundles = materialize(house_bundles(reg), "house-bundles")
        parts = bundle_parts(paths_of_bundles(bundles), reg.places, single_path=reg.single_rows)
        TextIndex.build(parts.select("bundle", joined().alias("address")), "address", f"{base}/addresses", buckets)
        rows = bundles.select("bundle", *HOUSE_KEYS, bucket_of("bundle", buckets).alias("bucket"))
        rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "bundle").write.partitionBy("bucket").parquet(f"{base}/houses")
        return cls(places.sparkSession, base)

    def _houses_of(self, places: DataFrame) -> DataFrame:
        """Houses of places (bundle, text), with their address columns; only the buckets of the places are read."""
        places = places.select("bundle", F.col("text").alias("address_without_house"), bucket_of("bundle", self.addresses.buckets).alias("bucket"))
        return self.houses.join(places, ["bucket", "bundle"]).select(
            F.col("objectid").alias("house_objectid"), "housenum", "addnum1", "addnum2", "address_without_house",
            F.concat("address_without_house", house_suffix()).alias("full_address"))

    def search_view(self, place_part: str, limit: int = 10) -> DataFrame:
        """As ``addresses.search_view``: first houses whose place address contains a text."""
        return self._houses_of(self.addresses.search(place_part)).orderBy(*ascending("housenum", "house_objectid")).limit(limit)

    def search_full_address(self, parts: list[str], limit: int = 5) -> DataFrame:
        """As ``addresses.search_full_address``: first houses whose full address contains all the texts.

        A part lies within the place's address, or it reaches into the house's own text. Parts that can't do
        the latter for any house are looked up in the index; if there is none, all houses are compared.
        """
        inside = [part for part in parts if not self._reaching(part)]
        rows = self._houses_of(self.addresses.search(*inside))
        for part in parts:
            rows = rows.where(contains_text("full_address", part))
        return rows.orderBy(*ascending("housenum", "house_objectid")).limit(limit).select("house_objectid", "full_address")

    def _reaching(self, part: str) -> bool:
        """Whether a part may match beyond the place's address in some house: its last piece ends with a beginning of the
        house's own text, or that holds a piece."""
        own = house_suffix()
        pieces = literal_pieces(part)
        if len(pieces) != 1 or pieces[0] != part:
            return True  # wildcards may stretch over both
        # The own text always begins alike: where none of the part's ends does, the part can only be inside it.
        ends = [end for k in range(1, len(part)) if (end := part[k:])[: len(HOUSE)].lower() == HOUSE[: len(part) - k].lower()]
        begins: list[Column] = [F.startswith(F.lower(own), F.lower(F.lit(end))) for end in ends]
        reaches = reduce(lambda a, b: a | b, begins, contains_text(own, part))
        return not self.houses.where(reaches).limit(1).isEmpty()

    def find_houses(self, reg: Registry, street_part: str, housenum: str, limit: int = 10) -> DataFrame:
        """As ``addresses.find_houses``: houses by part of the street name and the number, with their addresses."""
        streets = self.names.search(street_part).where(F.col("level") == "8").select(F.col("objectid").alias("parentobjid"))
        houses = reg.houses.where(F.col("housenum") == housenum).join(reg.hierarchy.join(streets, "parentobjid"), "objectid")
        return _addressed(reg, houses.select("objectid").orderBy(*ascending("objectid")).limit(limit))

    def child_by_name(self, reg: Registry, parent: int, part: str, level: str = "3") -> DataFrame:
        """As ``hierarchy.child_by_name``: children of a parent by level and part of the name."""
        places = self.names.search(part).where(F.col("level") == level).withColumnRenamed("text", "name")
        rows = places.join(reg.hierarchy.where(F.col("parentobjid") == parent), "objectid")
        return rows.select("objectid", "name", "typename", "level", "path").orderBy(*ascending("name", "objectid"))
