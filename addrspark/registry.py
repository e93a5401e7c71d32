"""The set of registry tables that the queries work on."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from addrspark.functions.names import display_name, level_number
from addrspark.functions.paths import under
from addrspark.sources.load_mark import files_digest, read_mark, write_mark
from addrspark.sources.path_bounds import read_bounds, read_under

#: The tables whose rows are counted by a check.
VERIFIED = ["apartments", "houses", "mun_hierarchy", "rooms"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; a ``region`` folder stays a text (``01``, not 1)."""
    table = spark.read.parquet(path)
    if "region" not in table.columns:
        return table
    fields = [T.StructField("region", T.StringType()) if f.name == "region" else f for f in table.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _active(hierarchy: DataFrame) -> DataFrame:
    return hierarchy.where("isactive = 1").select("objectid", "parentobjid", "path")


class Registry:
    """Registry tables by lower-case name, with the usual filtered forms.

    ``single_rows`` says that no object has several active hierarchy rows or
    several actual rows in its table; the queries then leave out the groupings that
    would merge them. ``verified`` finds out. ``base`` is the folder of stored tables.
    """

    def __init__(
        self, tables: Mapping[str, DataFrame], single_rows: bool = False,
        under: Callable[[str], DataFrame] | None = None, base: str | None = None,
    ):
        self.tables = dict(tables)
        self.single_rows = single_rows
        self._under = under
        self._base = base

    def verified(self) -> Registry:
        """The registry with ``single_rows`` set if a check of the tables allows it.

        To be called once after loading: it counts the rows of every object. For stored tables the result is kept
        beside them and found by ``from_parquet``, as long as the files are the same.
        """
        spark = [self.table(name) for name in VERIFIED][0].sparkSession
        tables, under = self.tables, self._under
        if self._base is not None:
            digest = files_digest(spark, self._base, VERIFIED)
            now = Registry.from_parquet(spark, self._base, list(tables))  # the files of the digest, also after an append
            tables, under = now.tables, now._under
        counted = Registry(tables)
        checked = [counted.hierarchy, counted.houses, counted.apartments, counted.rooms]
        repeated = [df.groupBy("objectid").count().where("count > 1").select("objectid") for df in checked]
        single = all(df.isEmpty() for df in repeated)
        if self._base is not None:
            write_mark(spark, self._base, digest, single)
        return Registry(tables, single, under, self._base)

    @classmethod
    def from_parquet(cls, spark: SparkSession, base: str, names: list[str]) -> Registry:
        """Tables stored as ``<base>/<name>`` parquet folders. A hierarchy with an index of its files is read by it.

        ``single_rows`` is set if a check of just these files found it so; a load since then makes the mark void.
        """
        single = set(VERIFIED) <= set(names) and read_mark(spark, base, VERIFIED)
        tables = {name: read_table(spark, f"{base}/{name}") for name in names}
        hierarchy, path = tables.get("mun_hierarchy"), f"{base}/mun_hierarchy"
        bounds = None if hierarchy is None else read_bounds(spark, path, hierarchy)
        if bounds is None:
            return cls(tables, single, base=base)
        return cls(
            tables, single, lambda prefix: read_under(spark, path, hierarchy.schema, bounds, prefix), base)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names: list[str]) -> Registry:
        """Tables of the catalog."""
        return cls({name: spark.table(f"{database}.{name}") for name in names})

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"table {name} is not loaded")
        return self.tables[name]

    @property
    def hierarchy(self) -> DataFrame:
        """Active rows of the municipal hierarchy."""
        return _active(self.table("mun_hierarchy"))

    def hierarchy_under(self, prefix: str | None, strict: bool = False) -> DataFrame:
        """Those whose path begins with a prefix (None: all); ``strict``: the object itself and whole steps below it."""
        if prefix is None:
            return self.hierarchy
        rows = self.hierarchy if self._under is None else _active(self._under(prefix))
        return rows.where(under(prefix, strict=strict))

    @property
    def places(self) -> DataFrame:
        """Actual address objects: the level as a number, ``label`` for display."""
        return (
            self.table("addr_obj")
            .where("isactual = 1")
            .select(
                "objectid",
                "objectguid",
                "name",
                "typename",
                "level",
                level_number("level").alias("level_num"),
                display_name("typename", "name").alias("label"),
            )
        )

    @property
    def levels(self) -> DataFrame:
        """Level numbers and names."""
        levels = self.table("object_levels")
        return levels.select(F.col("level").cast("bigint").alias("level_num"), F.col("name").alias("level_name"))

    @property
    def houses(self) -> DataFrame:
        return self.table("houses").where("isactual = 1").drop("isactual")

    @property
    def apartments(self) -> DataFrame:
        return self.table("apartments").where("isactual = 1").drop("isactual")

    @property
    def rooms(self) -> DataFrame:
        return self.table("rooms").where("isactual = 1").drop("isactual")
