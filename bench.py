"""Time the headline queries; prints one line of JSON.

The registry tables are derived from the base tables and stored as parquet first
(``load``) and checked for repeated rows (``verify``), as a registry is loaded once
and queried often. Every query is then run to its end, with all columns and rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from addrspark.fixtures import REGISTRY_TABLES, derived_registry  # noqa: E402
from addrspark.operators import quality as qua  # noqa: E402
from addrspark.plans import addresses as adr, hierarchy as hie, houses as hou, statistics as sta, wide as wid  # noqa: E402
from addrspark.registry import Registry  # noqa: E402
from addrspark.session import builder  # noqa: E402
from addrspark.sinks import render  # noqa: E402

QUERIES = {
    "aq2_addresses": adr.addresses,
    "aq4_apartment_addresses": adr.apartment_addresses,
    "aq5_houses_on_all_streets": adr.houses_on_street,
    "aq8_houses_with_addresses": adr.houses_with_addresses,
    "aq9_find_houses": lambda reg: adr.find_houses(reg, "customer#00000005", "45"),
    "aq10_counts_by_level": sta.counts_by_level,
    "aq1_address_chain": hie.address_chain,
    "mq4_numbered_children": hie.numbered_children,
    "mq6_ancestors": hie.ancestors,
    "mq11a_house_count": lambda reg: sta.house_count(reg, "1"),
    "mq11d_statistics": sta.full_statistics,
    "mq11g_addresses_through_parent": hou.addresses_through_parent,
    "mq12_all_houses": wid.all_houses,
    "mq13_all_apartments": wid.all_apartments,
    "mq14_all_rooms": wid.all_rooms,
    "j9_walk_down": lambda reg: hie.subtree(reg, reg.places.where("level_num = 1")),
    "q8_object_totals": qua.object_totals,
    "k1_csv_lines": lambda reg: render.row_lines(reg.table("houses"), render.CSV),
    "k5_insert_statements": lambda reg: render.insert_statements(
        reg.table("apartments"), "APARTMENTS", render.POSTGRES, ["objectid"]),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    base = tempfile.mkdtemp(prefix="addrspark-bench-")
    start = time.time()
    derived = derived_registry(spark, sf_dir)
    for name in REGISTRY_TABLES:
        derived.table(name).write.parquet(f"{base}/{name}")
    times["load"] = round(time.time() - start, 3)
    start = time.time()
    reg = Registry.from_parquet(spark, base, REGISTRY_TABLES).verified()
    times["verify"] = round(time.time() - start, 3)
    for name, query in QUERIES.items():
        start = time.time()
        query(reg).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total time of the registry queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
