"""The registered queries as SQL over the base tables, for comparison.

Written straightforwardly (every object is expanded by itself), so that it does
not share the shape of the Spark plans.
"""

from __future__ import annotations

import re

from addrspark.fixtures import oracle_ctes

COMMON = {
    "live": "SELECT * FROM mun_hierarchy WHERE isactive = 1",
    "place": """
  SELECT objectid, objectguid, name, typename, level, CAST(level AS BIGINT) AS level_num,
    CASE WHEN coalesce(typename, '') = '' THEN name ELSE typename || ' ' || name END AS label
  FROM addr_obj WHERE isactual = 1""",
    "step": """
  SELECT path, CAST(unnest(string_split(path, '.')) AS BIGINT) AS element,
    generate_subscripts(string_split(path, '.'), 1) AS pos
  FROM (SELECT DISTINCT path FROM mun_hierarchy)""",
    "placed": "SELECT path, pos, element, place.* FROM step JOIN place ON element = objectid",
    "house": "SELECT * FROM houses WHERE isactual = 1",
    "level_name": "SELECT CAST(level AS BIGINT) AS level_num, name AS level_name FROM object_levels",
}

LABELS = "string_agg(label, ', ' ORDER BY pos)"
HOUSE_SUFFIX = (
    "', д. ' || housenum || coalesce(' корп. ' || addnum1, '') || coalesce(' стр. ' || addnum2, '')"
)


def needed(body: str, tables: dict[str, str]) -> list[str]:
    """The tables that a text names, and those that they are made of, each after its own."""
    found: list[str] = []
    for name in reversed(tables):
        if any(re.search(rf"\b{name}\b", text) for text in (body, *[tables[f] for f in found])):
            found.append(name)
    return found[::-1]


def sql(body: str, recursive: bool = False) -> str:
    """``body`` after the registry tables that it needs; it may go on with more CTEs."""
    derived = oracle_ctes()
    tables = derived | COMMON
    ctes = [f"{name} AS {'MATERIALIZED ' if name in derived else ''}({tables[name]})" for name in needed(body, tables)]
    text = body.lstrip()
    if text.startswith(","):
        ctes.append(text[1:].lstrip())
        text = ""
    if not ctes:
        return text
    keyword = "WITH RECURSIVE" if recursive else "WITH"
    separator = ",\n"
    return f"{keyword} {separator.join(ctes)}\n{text}"


HOUSE_VIEW = f"""house_view AS (
  SELECT h.objectid AS house_objectid, housenum, addnum1, addnum2, {LABELS} AS address_without_house,
    {LABELS} || {HOUSE_SUFFIX} AS full_address
  FROM house h JOIN live l ON h.objectid = l.objectid JOIN placed p ON l.path = p.path
  GROUP BY h.objectid, housenum, addnum1, addnum2)"""

# Address per hierarchy path, and per house for the function forms.
PATH_ADDRESS = f"path_address AS (SELECT path, {LABELS} AS address FROM placed GROUP BY path)"
HOUSE_FUNCTION = f"""house_function AS (
  SELECT objectid, coalesce(address || {HOUSE_SUFFIX}, 'Адрес не найден') AS full_address
  FROM (SELECT h.objectid, housenum, addnum1, addnum2, path,
      row_number() OVER (PARTITION BY h.objectid ORDER BY path, housenum, addnum1, addnum2) AS rn
    FROM house h JOIN live l ON h.objectid = l.objectid) LEFT JOIN path_address USING (path) WHERE rn = 1)"""
ON_STREET = """on_street AS (
  SELECT h.*, l.path, a.name AS street_name, a.typename AS street_type, a.level AS street_level
  FROM house h JOIN live l ON h.objectid = l.objectid JOIN place a ON l.parentobjid = a.objectid)"""


def addresses() -> dict[str, str]:
    return {
        "aq2_addresses": sql(
            f"SELECT l.objectid AS target_objectid, {LABELS} AS full_address "
            "FROM live l JOIN placed p ON l.path = p.path GROUP BY l.objectid"
        ),
        "aq3_house_addresses": sql(
            f", {HOUSE_VIEW} SELECT house_objectid, housenum, full_address FROM house_view"
        ),
        "aq4_apartment_addresses": sql(f"""
            SELECT ap.objectid AS apartment_objectid, ap.number AS apartment_number,
              {LABELS} || {HOUSE_SUFFIX} || ', кв. ' || ap.number AS full_address
            FROM apartments ap JOIN mun_hierarchy own ON ap.objectid = own.objectid
              JOIN live l ON own.parentobjid = l.objectid JOIN house h ON h.objectid = l.objectid
              JOIN placed p ON l.path = p.path
            WHERE ap.isactual = 1 GROUP BY ap.objectid, ap.number, housenum, addnum1, addnum2"""),
        "aq5_houses_on_street": sql(f""", {ON_STREET}
            SELECT s.objectid AS house_objectid, housenum, addnum1, addnum2, street_name, street_type,
              string_agg(DISTINCT label, ', ' ORDER BY label) AS parent_address
            FROM on_street s JOIN placed p ON s.path = p.path
            WHERE street_name = 'Customer#000000052' AND street_type = 'building' AND street_level = '8'
              AND level_num <= 6
            GROUP BY ALL"""),
        "aq5_houses_on_all_streets": sql(f""", {ON_STREET}
            SELECT s.objectid AS house_objectid, housenum, addnum1, addnum2, street_name, street_type,
              string_agg(DISTINCT label, ', ' ORDER BY label) AS parent_address
            FROM on_street s JOIN placed p ON s.path = p.path
            WHERE street_level = '8' AND level_num <= 6 GROUP BY ALL"""),
        "aq6_full_address": sql(f""", {PATH_ADDRESS},
            wanted AS (SELECT objectid FROM addr_obj UNION SELECT objectid FROM steads
              UNION SELECT 20000000 + p_partkey FROM part),
            lowest AS (SELECT objectid, min(path) AS path FROM live GROUP BY objectid)
            SELECT w.objectid, coalesce(address, 'Адрес не найден') AS full_address
            FROM wanted w LEFT JOIN lowest l ON w.objectid = l.objectid LEFT JOIN path_address USING (path)"""),
        "aq7_house_address": sql(f""", {PATH_ADDRESS}, {HOUSE_FUNCTION},
            wanted AS (SELECT objectid FROM houses UNION SELECT 20000000 + p_partkey FROM part)
            SELECT w.objectid, coalesce(full_address, 'Адрес не найден') AS full_address
            FROM wanted w LEFT JOIN house_function f ON w.objectid = f.objectid"""),
        "aq8_houses_with_addresses": sql(f", {HOUSE_VIEW} SELECT * FROM house_view"),
        "aq9_find_houses": sql(f""", {PATH_ADDRESS}, {HOUSE_FUNCTION}, {ON_STREET}
            SELECT objectid, full_address FROM (SELECT objectid FROM on_street
              WHERE street_name ILIKE '%customer#00000005%' AND street_level = '8' AND housenum = '45'
              ORDER BY objectid LIMIT 10) JOIN house_function USING (objectid)"""),
        "at4_search_view": sql(f""", {HOUSE_VIEW} SELECT * FROM house_view
            WHERE address_without_house ILIKE '%Customer#00000005%' ORDER BY housenum, house_objectid LIMIT 10"""),
        "at5_search_full_address": sql(f""", {HOUSE_VIEW} SELECT house_objectid, full_address FROM house_view
            WHERE full_address ILIKE '%asia%' AND full_address ILIKE '%customer#00000005%'
            ORDER BY housenum, house_objectid LIMIT 5"""),
        "at6_houses_of_named_street": sql(f""", {PATH_ADDRESS}, {HOUSE_FUNCTION}, {ON_STREET}
            SELECT objectid AS house_objectid, housenum, full_address FROM (SELECT objectid, housenum FROM on_street
              WHERE street_name = 'Customer#000000052' AND street_type = 'building' AND street_level = '8'
              ORDER BY housenum, objectid LIMIT 10) JOIN house_function USING (objectid)"""),
    }


def hierarchy() -> dict[str, str]:
    ancestors = (
        "SELECT l.objectid AS target_objectid, pos AS position, element AS objectid, level, level_name, typename, name, "
        "label AS display_name FROM live l JOIN placed p ON l.path = p.path LEFT JOIN level_name USING (level_num)"
    )
    # Rows of a walk along the parent links, from the given start rows.
    node = "node AS (SELECT a.*, l.parentobjid, l.path FROM place a JOIN live l ON a.objectid = l.objectid)"
    walk = """, {node}, walk AS (
        SELECT objectid AS start, objectid, parentobjid, path, name, typename, label, level_num, 0 AS depth
        FROM node WHERE {first}
        UNION ALL
        SELECT w.start, n.objectid, n.parentobjid, n.path, n.name, n.typename, n.label, n.level_num, w.depth + 1
        FROM walk w JOIN node n ON {link} {limit})"""
    down, up = "n.parentobjid = w.objectid", "n.objectid = w.parentobjid"
    tree = """SELECT start AS root_objectid, repeat('  ', depth) || name AS name_indented, objectid,
        level_num AS level, typename, CAST(depth AS BIGINT) AS depth FROM walk"""

    def subtree(first: str, limit: str = "", tail: str = "") -> str:
        return sql(walk.format(node=node, first=first, link=down, limit=limit) + tree + tail, recursive=True)

    def children(extra: str) -> str:
        return f"""SELECT parentobjid, row_number() OVER (PARTITION BY parentobjid ORDER BY name, a.objectid) AS num,
            a.objectid, name, typename, path FROM place a JOIN live l ON a.objectid = l.objectid {extra}"""

    under = """SELECT a.objectid, level_num, level_name, typename, name, path, parentobjid
        FROM place a JOIN live l ON a.objectid = l.objectid LEFT JOIN level_name USING (level_num) """
    return {
        "aq1_address_chain": sql(walk.format(node=node, first="true", link=up, limit="") + """,
            whole AS (SELECT start, string_agg(label, ', ' ORDER BY level_num, depth DESC) AS full_address
              FROM walk GROUP BY start)
            SELECT w.start AS target_objectid, objectid, level_num AS level, typename, name,
              CAST(depth + 1 AS BIGINT) AS depth, full_address FROM walk w JOIN whole USING (start)""", recursive=True),
        "mq1_object_card": sql("""SELECT a.objectid, objectguid, a.name, typename, level, level_name, path, parentobjid
            FROM place a JOIN live l ON a.objectid = l.objectid LEFT JOIN level_name USING (level_num)"""),
        "mq2_ancestors_of_roots": sql(ancestors + " WHERE l.parentobjid IS NULL"),
        "mq4_numbered_children": sql(children("WHERE level = '3'")),
        "mq4_numbered_children_of_one": sql(children("WHERE level = '3' AND parentobjid = 1")),
        "mq5a_subtree_to_level_6": subtree("level_num = 1", "WHERE n.level_num <= 6"),
        "mq5b_subtree_of_one": subtree("objectid = 1", "", " ORDER BY path, objectid LIMIT 100"),
        "mq6_ancestors": sql(ancestors),
        "mq7_address_line": sql(f"""SELECT {LABELS} AS full_address FROM live l JOIN placed p ON l.path = p.path
            WHERE l.objectid = 1000052"""),
        "mq7_address_line_of_none": sql(f"""SELECT {LABELS} AS full_address FROM live l JOIN placed p
            ON l.path = p.path WHERE l.objectid = 20000000"""),
        "mq8_objects_under": sql(under + "WHERE starts_with(path, '1') AND level_num BETWEEN 1 AND 6"),
        "mq8_objects_to_level_8": sql(under + "WHERE level_num <= 8"),
        "mq8_objects_of_level_3": sql(under + "WHERE level_num = 3"),
        "mq8_objects_under_strict": sql(under + "WHERE (path = '1' OR starts_with(path, '1.')) AND level_num <= 8"),
        "mq9_child_by_name": sql("""SELECT a.objectid, name, typename, level, path FROM place a JOIN live l
            ON a.objectid = l.objectid WHERE parentobjid = 1 AND level = '3' AND name ILIKE '%a%'"""),
        "mq10_settlements_below": sql("""SELECT a.objectid, name, typename, level, level_name, path FROM place a
            JOIN live l ON a.objectid = l.objectid LEFT JOIN level_name USING (level_num)
            WHERE path LIKE '8.%' AND level_num IN (5, 6)"""),
        "j9_walk_down": subtree("level_num = 1"),
    }


def statistics() -> dict[str, str]:
    def levels(where: str, root: str = "") -> str:
        return f"""SELECT {root} level_num, level_name, count(*) AS object_count FROM place a
            JOIN live l ON a.objectid = l.objectid LEFT JOIN level_name USING (level_num) {where} GROUP BY ALL"""

    def houses(where: str, root: str = "") -> str:
        group = "GROUP BY ALL" if root else ""
        return f"SELECT {root} count(*) AS houses_count FROM house h JOIN live l ON h.objectid = l.objectid {where} {group}"

    def both(where: str) -> str:
        return f"""SELECT 'addr_obj' AS source_table, level_num, level_name, object_count AS count FROM ({levels(where)})
            UNION ALL SELECT 'houses', 10, 'Здание (дом)', houses_count FROM ({houses(where)})"""

    root = "CAST(string_split(path, '.')[1] AS BIGINT) AS root_objectid,"
    under = "WHERE path LIKE '{}%'".format
    return {
        "aq10_counts_by_level": sql("""SELECT level, level_name, count(*) AS total_objects,
              count(*) FILTER (isactual = 1) AS actual_objects, count(*) FILTER (isactive = 1) AS active_objects
            FROM (SELECT CAST(level AS BIGINT) AS level, isactual, isactive FROM addr_obj)
              LEFT JOIN level_name ON level = level_num GROUP BY ALL"""),
        "mq3_level_counts": sql(levels("WHERE path LIKE '1%' AND level_num <= 6")),
        "mq3_level_counts_strict": sql(levels("WHERE (path = '1' OR path LIKE '1.%') AND level_num <= 6")),
        "mq3_level_counts_by_root": sql(levels("WHERE level_num <= 6", root)),
        "mq5c_level_counts_of_district": sql(levels(under("1.100"))),
        "mq11a_house_count": sql(houses(under("1"))),
        "mq11a_house_count_strict": sql(houses("WHERE path = '1' OR path LIKE '1.%'")),
        "mq11a_house_counts_by_root": sql(houses("", root)),
        "mq11c_house_count_of_district": sql(houses(under("1.100"))),
        "mq11d_statistics_of_district": sql(both(under("1.100"))),
        "mq11d_statistics": sql(both("")),
    }


# The house types by code.
HOUSE_TYPE_NAMES = {
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
HOUSE_TYPE_SQL = "CASE housetype " + " ".join(f"WHEN {code} THEN '{name}'" for code, name in HOUSE_TYPE_NAMES.items()) + " ELSE 'Другое' END"


def houses() -> dict[str, str]:
    return {
        "mq11b_houses_of_streets": sql(f"""SELECT parentobjid AS street_objectid, h.objectid, housenum, addnum1, addnum2,
              housetype, {HOUSE_TYPE_SQL} AS housetype_name
            FROM house h JOIN live l ON h.objectid = l.objectid WHERE parentobjid IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY parentobjid ORDER BY housenum, h.objectid) <= 20"""),
        "mq11e_house_by_address": sql(f""", {ON_STREET} SELECT objectid, housenum, addnum1, addnum2, housetype,
              street_name, street_type FROM on_street
            WHERE street_name = 'Customer#000000052' AND street_type = 'building' AND housenum = '45'"""),
        "mq11f_actual_house_addresses": sql(f""", {PATH_ADDRESS}, {HOUSE_FUNCTION}
            SELECT h.objectid, coalesce(full_address, 'Адрес не найден') AS full_address
            FROM house h LEFT JOIN house_function f ON h.objectid = f.objectid"""),
        "mq11g_addresses_through_parent": sql(f"""SELECT h.objectid AS house_objectid,
              {LABELS} || {HOUSE_SUFFIX} AS full_address_level_1_to_10
            FROM house h JOIN live l ON h.objectid = l.objectid JOIN live up ON l.parentobjid = up.objectid
              JOIN placed p ON up.path = p.path GROUP BY h.objectid, housenum, addnum1, addnum2"""),
    }


def wide() -> dict[str, str]:
    levels = ", ".join(
        f"max(CASE WHEN level_num = {k} THEN {column} END) AS level_{k}_{name}"
        for k in (1, 3, 5, 6, 7, 8)
        for name, column in [("objectid", "element"), ("objectguid", "p.objectguid"), ("typename", "typename"), ("name", "name")]
    )
    house = "house_id, house_guid, housenum, addnum1, addnum2, housetype"
    flat = ", flat_id, flat_guid, flat_number, aparttype"
    room = ", room_id, room_guid, room_number, roomtype"
    house_out = """house_id AS level_10_objectid, house_guid AS level_10_objectguid, housenum AS level_10_housenum,
        addnum1 AS level_10_addnum1, addnum2 AS level_10_addnum2, housetype AS level_10_housetype, """
    flat_out = """flat_id AS level_9_objectid, flat_guid AS level_9_objectguid, flat_number AS level_9_number,
        aparttype AS level_9_aparttype, """
    room_out = """room_id AS level_65_objectid, room_guid AS level_65_objectguid, room_number AS level_65_number,
        roomtype AS level_65_roomtype, """
    flat_tail, room_tail = "coalesce(', кв. ' || flat_number, '')", "coalesce(', пом. ' || room_number, '')"

    def table(kind: str, prefix: str = "", keep_empty: bool = False) -> str:
        keys, out, tail, last, more = house, house_out, "''", "", ""
        if kind in ("flat", "room"):
            keys, out, tail, last = keys + flat, flat_out + out, flat_tail, "flat_id"
            more = """LEFT JOIN live fl ON fl.parentobjid = house_id LEFT JOIN (SELECT objectid AS flat_id,
                objectguid AS flat_guid, number AS flat_number, aparttype FROM apartments WHERE isactual = 1) f
                ON fl.objectid = flat_id"""
        if kind == "room":
            keys, out, tail, last = keys + room, room_out + out, tail + " || " + room_tail, "room_id"
            more += """ LEFT JOIN live rl ON rl.parentobjid = flat_id LEFT JOIN (SELECT objectid AS room_id,
                objectguid AS room_guid, number AS room_number, roomtype FROM rooms WHERE isactual = 1) r
                ON rl.objectid = room_id"""
        filled = f"WHERE {last} IS NOT NULL" if last and not keep_empty else ""
        return sql(f""", base AS (
            SELECT h.objectid AS house_id, h.objectguid AS house_guid, housenum, addnum1, addnum2, housetype,
              up.path AS street_path
            FROM house h JOIN live l ON h.objectid = l.objectid JOIN live up ON l.parentobjid = up.objectid
            WHERE starts_with(l.path, '{prefix}'))
            SELECT {out} {levels}, {LABELS} || {HOUSE_SUFFIX} || {tail} AS full_address
            FROM base {more} JOIN placed p ON street_path = p.path {filled} GROUP BY {keys}""")

    return {
        "mq12_all_houses": table("house"),
        "mq12_all_houses_under": table("house", prefix="1"),
        "mq13_all_apartments": table("flat"),
        "mq13_all_apartments_keep_empty": table("flat", keep_empty=True),
        "mq14_all_rooms": table("room"),
        "mq14_all_rooms_keep_empty": table("room", keep_empty=True),
    }


def searches() -> dict[str, str]:
    plain = addresses() | hierarchy()
    same = ["aq9_find_houses", "at4_search_view", "at5_search_full_address", "mq9_child_by_name"]
    return {f"{key}_indexed": plain[key] for key in same} | {
        "mq5a_subtree_labelled": plain["mq5a_subtree_to_level_6"],
        "mq5b_subtree_labelled": plain["mq5b_subtree_of_one"],
        "at5_search_house_part_indexed": sql(f""", {HOUSE_VIEW} SELECT house_objectid, full_address FROM house_view
            WHERE full_address ILIKE '%asia%' AND full_address ILIKE '%5, д. 45%'
            ORDER BY housenum, house_objectid LIMIT 1000"""),
        "e12_indexed": "SELECT doc_id FROM documents WHERE text ILIKE '%eauÉ%' AND text ILIKE '%la%'",
        "e12_indexed_short_part": "SELECT doc_id FROM documents WHERE text ILIKE '%ç%'",
    }


def verified() -> dict[str, str]:
    """A verified registry gives the same rows."""
    plain = addresses() | houses() | wide()
    keys = [
        "aq2_addresses", "aq4_apartment_addresses", "aq8_houses_with_addresses", "mq11g_addresses_through_parent",
        "mq12_all_houses", "mq13_all_apartments", "mq14_all_rooms",
    ]
    return {f"{key}_verified": plain[key] for key in keys}


def oracle_sql() -> dict[str, str]:
    return verified() | searches() | addresses() | hierarchy() | statistics() | houses() | wide()
