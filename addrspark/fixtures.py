"""Registry-shaped tables derived from the base test tables.

One text per table; ``{name}`` stands for another table. Spark fills it with a
DataFrame, the oracle with the name of a view or CTE.

region -> level 1, nation -> level 3 or 5, customer -> level 7 or 8, orders ->
houses, odd line numbers -> apartments, even ones -> rooms, supplier -> steads.
Carried on purpose: ids 1 and 15 (a prefix trap), old and non-actual rows, empty
and missing type names, missing house numbers, inactive hierarchy rows.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from addrspark.registry import Registry

BASE_TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "documents"]

DERIVED = {
    "object_levels": """
SELECT * FROM (VALUES (1,'Region'),(2,'Admin district'),(3,'Municipal district'),
  (4,'Settlement'),(5,'City'),(6,'Locality'),(7,'Planning element'),(8,'Street'),
  (10,'House')) AS t(level, name)""",
    "addr_obj": """
SELECT CAST(r_regionkey*7+1 AS BIGINT) AS objectid, concat('r-', CAST(r_regionkey AS STRING)) AS objectguid,
  r_name AS name, 'reg' AS typename, '1' AS level, 1 AS isactual, 1 AS isactive FROM {region}
UNION ALL
SELECT CAST(100+n_nationkey AS BIGINT), concat('n-', CAST(n_nationkey AS STRING)), n_name,
  CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'mun' END,
  CASE WHEN n_nationkey % 4 = 3 THEN '5' ELSE '3' END, 1, 1 FROM {nation}
UNION ALL
SELECT CAST(1000000+c_custkey AS BIGINT), concat('c-', CAST(c_custkey AS STRING)), c_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE lower(c_mktsegment) END,
  CASE WHEN c_custkey % 9 = 0 THEN '7' ELSE '8' END,
  CASE WHEN c_custkey % 10 = 9 THEN 0 ELSE 1 END, CASE WHEN c_custkey % 20 = 19 THEN 0 ELSE 1 END FROM {customer}
UNION ALL
SELECT CAST(1000000+c_custkey AS BIGINT), concat('c-', CAST(c_custkey AS STRING)), concat(c_name, ' (old)'),
  'old', '8', 0, 0 FROM {customer} WHERE c_custkey % 6 = 0""",
    "houses": """
SELECT CAST(100000000+o_orderkey AS BIGINT) AS objectid, concat('o-', CAST(o_orderkey AS STRING)) AS objectguid,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey % 300 AS STRING) END AS housenum,
  CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS addnum1,
  CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey % 7 AS STRING) END AS addnum2,
  CAST(o_orderkey % 15 AS INT) AS housetype, CASE WHEN o_orderkey % 13 = 12 THEN 0 ELSE 1 END AS isactual
FROM {orders}""",
    "units": """
SELECT l_orderkey, l_linenumber, CAST(10000000000 + l_orderkey*10 + l_linenumber AS BIGINT) AS objectid
FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "apartments": """
SELECT objectid, concat('a-', CAST(objectid AS STRING)) AS objectguid, CAST(l_linenumber AS STRING) AS number,
  CAST(l_orderkey % 6 AS INT) AS aparttype, CASE WHEN l_orderkey % 17 = 16 THEN 0 ELSE 1 END AS isactual
FROM {units} WHERE l_linenumber % 2 = 1""",
    "rooms": """
SELECT objectid, concat('m-', CAST(objectid AS STRING)) AS objectguid, CAST(l_linenumber AS STRING) AS number,
  CAST(l_orderkey % 3 AS INT) AS roomtype, 1 AS isactual
FROM {units} WHERE l_linenumber % 2 = 0""",
    "steads": """
SELECT CAST(10000+s_suppkey AS BIGINT) AS objectid, concat('s-', CAST(s_suppkey AS STRING)) AS objectguid,
  s_name AS number, 1 AS isactual FROM {supplier}""",
    "normative_docs": """
SELECT doc_id AS id, CASE WHEN doc_id % 23 = 0 THEN NULL ELSE source END AS name FROM {documents}""",
    "mun_hierarchy": """
SELECT CAST(r_regionkey*7+1 AS BIGINT) AS objectid, CAST(NULL AS BIGINT) AS parentobjid,
  CAST(r_regionkey*7+1 AS STRING) AS path, 1 AS isactive FROM {region}
UNION ALL
SELECT CAST(100+n_nationkey AS BIGINT), CAST(n_regionkey*7+1 AS BIGINT),
  concat(CAST(n_regionkey*7+1 AS STRING), '.', CAST(100+n_nationkey AS STRING)), 1 FROM {nation}
UNION ALL
SELECT CAST(10000+s_suppkey AS BIGINT), CAST(100+n_nationkey AS BIGINT),
  concat(CAST(n_regionkey*7+1 AS STRING), '.', CAST(100+n_nationkey AS STRING), '.', CAST(10000+s_suppkey AS STRING)), 1
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT CAST(1000000+c_custkey AS BIGINT), CAST(100+n_nationkey AS BIGINT),
  concat(CAST(n_regionkey*7+1 AS STRING), '.', CAST(100+n_nationkey AS STRING), '.', CAST(1000000+c_custkey AS STRING)),
  CASE WHEN c_custkey % 50 = 49 THEN 0 ELSE 1 END
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT CAST(100000000+o_orderkey AS BIGINT), CAST(1000000+c_custkey AS BIGINT),
  concat(CAST(n_regionkey*7+1 AS STRING), '.', CAST(100+n_nationkey AS STRING), '.', CAST(1000000+c_custkey AS STRING),
    '.', CAST(100000000+o_orderkey AS STRING)),
  CASE WHEN o_orderkey % 40 = 39 THEN 0 ELSE 1 END
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT u.objectid, CASE WHEN u.l_linenumber % 2 = 1 THEN CAST(100000000+o_orderkey AS BIGINT) ELSE u.objectid - 1 END,
  concat(CAST(n_regionkey*7+1 AS STRING), '.', CAST(100+n_nationkey AS STRING), '.', CAST(1000000+c_custkey AS STRING),
    '.', CAST(100000000+o_orderkey AS STRING),
    CASE WHEN u.l_linenumber % 2 = 0 THEN concat('.', CAST(u.objectid - 1 AS STRING)) ELSE '' END,
    '.', CAST(u.objectid AS STRING)), 1
FROM {units} u JOIN {orders} ON u.l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey""",
}

REGISTRY_TABLES = [name for name in DERIVED if name != "units"]


def sources(name: str) -> list[str]:
    """The tables a derived table is made from."""
    return sorted({field for _, field, _, _ in string.Formatter().parse(DERIVED[name]) if field})


def derived_registry(spark: SparkSession, sf_dir: str) -> Registry:
    """The registry tables over the parquet files in ``sf_dir``, not yet computed."""
    frames: dict[str, DataFrame] = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in BASE_TABLES}
    for name, text in DERIVED.items():
        frames[name] = spark.sql(text, **{source: frames[source] for source in sources(name)})
    return Registry({name: frames[name] for name in REGISTRY_TABLES})


def oracle_ctes() -> dict[str, str]:
    """The same tables as CTEs over the base views, each after those that it reads."""
    names = {name: name for name in [*BASE_TABLES, *DERIVED]}
    return {name: text.format(**names) for name, text in DERIVED.items()}
