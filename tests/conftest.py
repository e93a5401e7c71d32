import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from addrspark.fixtures import REGISTRY_TABLES, derived_registry  # noqa: E402
from addrspark.registry import Registry  # noqa: E402
from addrspark.session import builder  # noqa: E402
from rows import house, link, place  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """The derived registry as parquet tables."""
    base = str(tmp_path_factory.mktemp("stored"))
    derived = derived_registry(spark, "/root/testdata/sf0.001")
    for name in REGISTRY_TABLES:
        derived.table(name).write.parquet(f"{base}/{name}")
    return Registry.from_parquet(spark, base, REGISTRY_TABLES)


ADDR_OBJ = "objectid long, objectguid string, name string, typename string, level string, isactual int, isactive int"
HIERARCHY = "objectid long, parentobjid long, path string, isactive int"
HOUSES = "objectid long, objectguid string, housenum string, addnum1 string, addnum2 string, housetype int, isactual int"
APARTMENTS = "objectid long, objectguid string, number string, aparttype int, isactual int"
ROOMS = "objectid long, objectguid string, number string, roomtype int, isactual int"
LEVELS = "level int, name string"


@pytest.fixture(scope="session")
def make_registry(spark):
    """Registry from literal rows; tables left out are empty."""
    schemas = {
        "addr_obj": ADDR_OBJ, "mun_hierarchy": HIERARCHY, "houses": HOUSES, "apartments": APARTMENTS, "rooms": ROOMS,
        "object_levels": LEVELS,
    }

    def make(**rows):
        return Registry({name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in schemas.items()})
    return make


@pytest.fixture(scope="session")
def moscow(make_registry):
    """The documented sample: a city, a district, a street, houses, a district with a town."""
    return make_registry(
        addr_obj=[
            place(1405113, "Москва", "г", 1),
            place(95251254, "муниципальный округ Арбат", "вн.тер.г.", 3),
            place(1447085, "Арбат", "ул", 8),
            place(95251365, "городской округ Троицк", "вн.тер.г.", 3),
            place(811934, "Троицк", "г", 5),
            place(811935, "Старая", "ул", 8, actual=0),
        ],
        mun_hierarchy=[
            link("1405113"), link("1405113.95251254"), link("1405113.95251254.1447085"),
            link("1405113.95251254.1447085.67054556"), link("1405113.95251254.1447085.67054557"),
            link("1405113.95251254.1447085.67054558"), link("1405113.95251365"), link("1405113.95251365.811934"),
            link("1405113.95251365.811935"), link("1405113.95251365.811935.5"), link("14051139.7"),
        ],
        houses=[
            house(67054556, "10"), house(67054557, "12", "1", "2", housetype=99), house(67054558, None),
            house(5, "1"),
        ],
        object_levels=[(1, "Субъект РФ"), (3, "Муниципальный район"), (5, "Город"), (8, "Элемент улично-дорожной сети")],
    )
