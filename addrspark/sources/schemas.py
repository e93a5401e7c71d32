"""Tables of the registry: which schema, key and place each one has.

A schema is a ``StructType``: a field that is not nullable is required, and
``max_length`` in its metadata limits a text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Tables without a region and the entity that describes each.
COMMON_TABLES = {
    "ADDHOUSE_TYPES": "HOUSE_TYPES",
    "ADDR_OBJ_TYPES": "ADDR_OBJ_TYPES",
    "APARTMENT_TYPES": "APARTMENT_TYPES",
    "HOUSE_TYPES": "HOUSE_TYPES",
    "NORMATIVE_DOCS_KINDS": "NORMATIVE_DOCS_KINDS",
    "NORMATIVE_DOCS_TYPES": "NORMATIVE_DOCS_TYPES",
    "OBJECT_LEVELS": "OBJECT_LEVELS",
    "OPERATION_TYPES": "OPERATION_TYPES",
    "PARAM_TYPES": "PARAM_TYPES",
    "ROOM_TYPES": "ROOM_TYPES",
}
# Tables with one file per region; all parameter tables share an entity.
REGION_TABLES = {
    "ADDR_OBJ": "ADDR_OBJ",
    "ADDR_OBJ_DIVISION": "ADDR_OBJ_DIVISION",
    "ADDR_OBJ_PARAMS": "PARAM",
    "ADM_HIERARCHY": "ADM_HIERARCHY",
    "APARTMENTS": "APARTMENTS",
    "APARTMENTS_PARAMS": "PARAM",
    "CARPLACES": "CARPLACES",
    "CARPLACES_PARAMS": "PARAM",
    "CHANGE_HISTORY": "CHANGE_HISTORY",
    "HOUSES": "HOUSES",
    "HOUSES_PARAMS": "PARAM",
    "MUN_HIERARCHY": "MUN_HIERARCHY",
    "NORMATIVE_DOCS": "NORMATIVE_DOCS",
    "REESTR_OBJECTS": "REESTR_OBJECTS",
    "ROOMS": "ROOMS",
    "ROOMS_PARAMS": "PARAM",
    "STEADS": "STEADS",
    "STEADS_PARAMS": "PARAM",
}
TABLES = COMMON_TABLES | REGION_TABLES
# Primary keys other than ID.
OTHER_KEYS = {"OBJECT_LEVELS": "LEVEL", "CHANGE_HISTORY": "CHANGEID", "REESTR_OBJECTS": "OBJECTID"}

# The default length of a text without one, and the longest limited text.
DEFAULT_LENGTH = 128
LONGEST_LIMIT = 255
# Integers by their number of digits.
INTEGERS_BY_DIGITS = {5: T.ShortType(), 10: T.IntegerType(), 19: T.LongType()}


def entity_of(table: str) -> str:
    """The entity whose schema the table has."""
    if table.upper() not in TABLES:
        raise KeyError(f"unknown table {table}")
    return TABLES[table.upper()]


def primary_key(table: str) -> str:
    return OTHER_KEYS.get(table.upper(), "ID").lower()


def select_tables(names: list[str] | None = None) -> list[str]:
    """Known tables in load order, limited to ``names``; unknown names are an error."""
    wanted = None if names is None else {name.upper() for name in names}
    unknown = sorted((wanted or set()) - set(TABLES))
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(unknown)}")
    return [name for name in TABLES if wanted is None or name in wanted]


def text(name: str, max_length: int | None = None) -> T.StructField:
    """A text field; texts are nullable even where declared as required."""
    limited = max_length is not None and max_length <= LONGEST_LIMIT
    return T.StructField(name, T.StringType(), True, {"max_length": max_length} if limited else {})


def declared_field(
    name: str,
    type_name: str | None = None,
    base: str | None = None,
    digits: int | None = None,
    length: int | None = None,
    required: bool = False,
) -> T.StructField:
    """A field from the facts of a schema document.

    ``base`` is the base type of a restriction, ``type_name`` a plain type; both
    without namespace.
    """
    if base == "string":
        return text(name, length or DEFAULT_LENGTH)
    if type_name == "string":
        return text(name, DEFAULT_LENGTH)
    if base in ("integer", "int", "long"):
        kind: T.DataType = INTEGERS_BY_DIGITS.get(digits, T.IntegerType())
    elif base == "byte":
        kind = T.ShortType()
    elif base == "date" or type_name == "date":
        kind = T.DateType()
    elif type_name in ("boolean", "integer", "long"):
        kind = {"boolean": T.BooleanType(), "integer": T.IntegerType(), "long": T.LongType()}[type_name]
    else:
        return T.StructField(name, T.StringType(), not required, {"max_length": DEFAULT_LENGTH})
    return T.StructField(name, kind, not required)


def _number(name: str, kind: T.DataType, required: bool = True) -> T.StructField:
    return T.StructField(name, kind, not required)


LONG, INT = T.LongType(), T.IntegerType()

# The columns that the queries read, by entity. The rest of a table is read when
# its schema document is given.
QUERY_SCHEMAS = {
    "OBJECT_LEVELS": T.StructType([_number("LEVEL", INT), text("NAME", 250)]),
    "ADDR_OBJ": T.StructType([
        _number("OBJECTID", LONG), text("OBJECTGUID", 36), text("NAME", 250), text("TYPENAME", 50), text("LEVEL", 10),
        _number("ISACTUAL", INT), _number("ISACTIVE", INT),
    ]),
    "MUN_HIERARCHY": T.StructType([
        _number("OBJECTID", LONG), _number("PARENTOBJID", LONG, False), text("PATH"), _number("ISACTIVE", INT),
    ]),
    "HOUSES": T.StructType([
        _number("OBJECTID", LONG), text("OBJECTGUID", 36), text("HOUSENUM", 50), text("ADDNUM1", 50),
        text("ADDNUM2", 50), _number("HOUSETYPE", INT, False), _number("ISACTUAL", INT),
    ]),
    "APARTMENTS": T.StructType([
        _number("OBJECTID", LONG), text("OBJECTGUID", 36), text("NUMBER", 50), _number("APARTTYPE", INT),
        _number("ISACTUAL", INT),
    ]),
    "ROOMS": T.StructType([
        _number("OBJECTID", LONG), text("OBJECTGUID", 36), text("NUMBER", 50), _number("ROOMTYPE", INT),
        _number("ISACTUAL", INT),
    ]),
    "STEADS": T.StructType([
        _number("OBJECTID", LONG), text("OBJECTGUID", 36), text("NUMBER", 250), _number("ISACTUAL", INT),
    ]),
    "NORMATIVE_DOCS": T.StructType([_number("ID", LONG), text("NAME")]),
}


def query_schema(table: str) -> T.StructType:
    """The schema of a table's columns that the queries read."""
    entity = entity_of(table)
    if entity not in QUERY_SCHEMAS:
        raise KeyError(f"no built-in schema for {table}: give its schema document")
    return QUERY_SCHEMAS[entity]


def lower_names(schema: T.StructType) -> T.StructType:
    """The schema as loaded: column names in lower case."""
    return T.StructType([T.StructField(f.name.lower(), f.dataType, f.nullable, f.metadata) for f in schema.fields])
