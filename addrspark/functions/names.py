"""Column expressions for display names and the tail of an address."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# House types by code, the text for any other code, and the text
# returned for an id without an address.
HOUSE_TYPES = {
    1: "Дом",
    2: "Домовладение",
    3: "Гараж",
    4: "Здание",
    5: "Шахта",
    6: "Строение",
    7: "Сооружение",
    8: "Литера",
    9: "Корпус",
    10: "Подвал",
    11: "Котельная",
    12: "Погреб",
    13: "Объект незавершенного строительства",
}
OTHER_HOUSE_TYPE = "Другое"
NOT_FOUND = "Адрес не найден"
# The words before each number of an address.
HOUSE = ", д. "
BUILDING = " корп. "
STRUCTURE = " стр. "
APARTMENT = ", кв. "
ROOM = ", пом. "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def display_name(typename: Column | str, name: Column | str) -> Column:
    """Type and name; the bare name when the type is missing or empty."""
    typename, name = _col(typename), _col(name)
    return F.when(typename != "", F.concat(typename, F.lit(" "), name)).otherwise(name)


def level_number(level: Column | str) -> Column:
    return _col(level).cast("bigint")


def optional(prefix: str, value: Column | str) -> Column:
    """``prefix`` and value, or an empty text when the value is missing."""
    return F.coalesce(F.concat(F.lit(prefix), _col(value)), F.lit(""))


def house_suffix(housenum="housenum", addnum1="addnum1", addnum2="addnum2") -> Column:
    """House number with its two optional additions; NULL without a number."""
    return F.concat(F.lit(HOUSE), _col(housenum), optional(BUILDING, addnum1), optional(STRUCTURE, addnum2))


def apartment_suffix(number: Column | str = "number", required: bool = False) -> Column:
    """Apartment number; ``required`` gives NULL, not an empty text, without one."""
    if required:
        return F.concat(F.lit(APARTMENT), _col(number))
    return optional(APARTMENT, number)


def room_suffix(number: Column | str = "number") -> Column:
    return optional(ROOM, number)


def house_type_name(code: Column | str) -> Column:
    names = F.create_map(*[F.lit(x) for pair in HOUSE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, _col(code)), F.lit(OTHER_HOUSE_TYPE))


def indented(name: Column | str, depth: Column | str) -> Column:
    """Name moved right by two blanks per level of depth."""
    return F.concat(F.repeat(F.lit("  "), _col(depth).cast("int")), _col(name))


def or_not_found(address: Column | str) -> Column:
    return F.coalesce(_col(address), F.lit(NOT_FOUND))


def contains_text(text: Column | str, part: str) -> Column:
    """Case-insensitive substring match; wildcards in ``part`` count as such."""
    return _col(text).ilike(f"%{part}%")
