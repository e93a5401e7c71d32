"""The registered operators as SQL over the base tables."""

from __future__ import annotations

import string

from addrspark.checks.oracle import HOUSE_SUFFIX, HOUSE_TYPE_SQL, ON_STREET, hierarchy, sql
from addrspark.checks.xml_fixture import DECLARED, ELEMENTS, RANGE, SECTIONS

# The columns of the declared tables, in order.
COLUMNS = {
    "object_levels": ["level", "name", "isactive", "updatedate"],
    "normative_docs": ["id", "name", "updatedate"],
    "addr_obj_params": ["id", "objectid", "typeid", "value", "updatedate"],
    "houses_params": ["id", "objectid", "typeid", "value", "updatedate"],
    "addr_obj": ["id", "objectid", "objectguid", "name", "typename", "level", "isactual", "isactive", "updatedate"],
    "houses": ["id", "objectid", "objectguid", "housenum", "addnum1", "addnum2", "housetype", "isactual", "updatedate"],
    "apartments": ["id", "objectid", "objectguid", "number", "aparttype", "isactual", "updatedate"],
    "rooms": ["id", "objectid", "objectguid", "number", "roomtype", "isactual", "updatedate"],
    "steads": ["id", "objectid", "objectguid", "number", "isactual", "updatedate"],
    "mun_hierarchy": ["id", "objectid", "parentobjid", "path", "isactive", "updatedate"],
}
KEYS = dict.fromkeys(COLUMNS, "id") | {"object_levels": "level"}

SCHEMA_DOCUMENTS = """SELECT * FROM (VALUES
  ('OBJECT_LEVELS', 'OBJECTLEVEL', 'LEVEL int required, NAME string, ISACTIVE boolean, UPDATEDATE date'),
  ('NORMATIVE_DOCS', 'NORMDOC', 'ID bigint required, NAME string, UPDATEDATE date'),
  ('PARAM', 'PARAM', 'ID bigint required, OBJECTID bigint required, TYPEID int, VALUE string, UPDATEDATE date'),
  ('ADDR_OBJ', 'OBJECT', 'ID bigint required, OBJECTID bigint required, OBJECTGUID string, NAME string, TYPENAME string, LEVEL string, ISACTUAL int, ISACTIVE int, UPDATEDATE date'),
  ('HOUSES', 'HOUSE', 'ID bigint required, OBJECTID bigint required, OBJECTGUID string, HOUSENUM string, ADDNUM1 string, ADDNUM2 string, HOUSETYPE int, ISACTUAL int, UPDATEDATE date'),
  ('APARTMENTS', 'APARTMENT', 'ID bigint required, OBJECTID bigint required, OBJECTGUID string, NUMBER string, APARTTYPE int, ISACTUAL int, UPDATEDATE date'),
  ('ROOMS', 'ROOM', 'ID bigint required, OBJECTID bigint required, OBJECTGUID string, NUMBER string, ROOMTYPE int, ISACTUAL int, UPDATEDATE date'),
  ('STEADS', 'STEAD', 'ID bigint required, OBJECTID bigint required, OBJECTGUID string, NUMBER string, ISACTUAL int, UPDATEDATE date'),
  ('MUN_HIERARCHY', 'ITEM', 'ID bigint required, OBJECTID bigint required, PARENTOBJID bigint, PATH string, ISACTIVE int, UPDATEDATE date')
) AS t(entity, row_tag, columns)"""

OBJECTS = ["addr_obj", "houses", "apartments", "steads", "rooms"]
REGISTRY = ["object_levels", "addr_obj", "houses", "apartments", "rooms", "steads", "normative_docs", "mun_hierarchy"]
REGION_OF = "JOIN (SELECT objectid, string_split(path, '.')[1] AS region FROM mun_hierarchy) r USING (objectid)"


def _plain(text: str) -> str:
    """A text of the fixture with the names of the tables."""
    return text.format(**{field: field for _, field, _, _ in string.Formatter().parse(text) if field})


def _counts(tables: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables)


def quality() -> dict[str, str]:
    def unpivoted(name: str, conditions: dict[str, str], table: str, tag: str = "") -> str:
        return " UNION ALL ".join(
            f"SELECT {tag} '{column}' AS column_name, count(*) FILTER ({condition}) AS {name} FROM {table}"
            for column, condition in conditions.items()
        )

    required = {
        "addr_obj": ["objectid", "isactual", "isactive"],
        "apartments": ["objectid", "aparttype", "isactual"],
        "houses": ["objectid", "isactual"],
        "mun_hierarchy": ["objectid", "parentobjid", "isactive"],
        "normative_docs": ["id"],
        "rooms": ["objectid", "roomtype", "isactual"],
        "steads": ["objectid", "isactual"],
    }
    missing = " UNION ALL ".join(
        unpivoted("missing", {c: f"{c} IS NULL" for c in columns}, table, f"'{table}' AS table_name,")
        for table, columns in required.items()
    )
    keys = {t: "objectid" for t in required} | {"normative_docs": "id", "object_levels": "level"}
    repeated = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({k} AS BIGINT) AS key, count(*) AS copies FROM {t} GROUP BY ALL "
        "HAVING count(*) > 1"
        for t, k in keys.items()
    )
    numbers = ["objectid", "addnum1", "addnum2", "housetype", "isactual"]
    not_numbers = {c: f"{c} IS NOT NULL AND try_cast({c} AS BIGINT) IS NULL" for c in numbers}
    lengths = {"name": 8, "typename": 9, "level": 10}
    twice = "SELECT objectid, {} AS copies FROM {} GROUP BY objectid HAVING {} > 1 ORDER BY objectid LIMIT 10".format
    main = "(SELECT count(*) FROM addr_obj) + (SELECT count(*) FROM houses) + (SELECT count(*) FROM steads)"
    largest = f"SELECT * FROM ({_counts(REGISTRY)}) ORDER BY row_count DESC, table_name LIMIT "
    plain = f"(objectid // {RANGE}) % {len(SECTIONS)}"
    marks = "CASE kind " + " ".join(f"WHEN {i} THEN {len(a) + len(b) + 2}" for i, (a, b) in enumerate(SECTIONS)) + " END"
    sized = " UNION ALL ".join(
        f"""SELECT '{t.lower()}' AS table_name, CAST(sum(n) FILTER (kind = 0) AS BIGINT) AS row_count,
            CAST(sum(bytes + {marks}) AS BIGINT) AS bytes
        FROM (SELECT {plain} AS kind, objectid // {RANGE} AS number, count(*) AS n, sum(strlen(line) + 1) AS bytes
            FROM ({_plain(text)}) GROUP BY ALL)""" for t, text in ELEMENTS.items())
    return {
        "q1_typed": sql("SELECT * FROM houses"),
        "q1_unparsed": sql(unpivoted("unparsed", not_numbers, "houses")),
        "q2_boolean_numbers": sql("SELECT objectid, name, CAST(isactive AS BIGINT) AS isactive FROM addr_obj"),
        "q3_missing_required": sql(missing),
        "q4_too_long": sql(unpivoted("too_long", {c: f"length({c}) > {n}" for c, n in lengths.items()}, "addr_obj")),
        "q5_duplicate_keys": sql(repeated),
        "q5_primary_keys": sql(" UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST({KEYS[t]} AS BIGINT) AS key, count(*) AS copies "
            f"FROM ({_plain(text)}) GROUP BY ALL HAVING count(*) > 1" for t, text in DECLARED.items())),
        "q6_duplicate_objects": sql(twice("count(*)", "addr_obj", "count(*)")),
        "q6_duplicate_objects_loaded_twice": sql(twice("2 * count(*)", "houses", "2 * count(*)")),
        "q7_object_counts": sql(_counts(OBJECTS)),
        "q8_object_totals": sql(f"""SELECT CAST(sum(row_count) AS BIGINT) AS total_objects,
            {main} AS main_objects FROM ({_counts(OBJECTS)})"""),
        "q9_missing_names": sql("""SELECT count(*) AS total, count(*) FILTER (name IS NULL) AS null_count,
            round(100.0 * count(*) FILTER (name IS NULL) / count(*), 1) AS null_percent FROM normative_docs"""),
        "q10_largest_tables": sql(largest + "20"),
        "q10_sized_tables": sql(f"SELECT * FROM ({sized}) ORDER BY row_count DESC, table_name"),
        "q11_check_expected": sql(f"""SELECT n AS main_objects, CAST(17000 AS BIGINT) AS expected,
            round(100.0 * abs(n - 17000) / 17000, 1) AS difference_percent, 100.0 * abs(n - 17000) / 17000 <= 10 AS passed
            FROM (SELECT {main} AS n)"""),
        "q11_check_expected_none": sql(f"""SELECT {main} AS main_objects, CAST(0 AS BIGINT) AS expected,
            CAST(NULL AS DOUBLE) AS difference_percent, CAST(NULL AS BOOLEAN) AS passed"""),
        "q12_load_monitor": sql(largest + "10"),
        "q13_table_counts": sql(_counts(["houses", "apartments", "addr_obj"])),
    }


def expressions() -> dict[str, str]:
    # Separators as in the package; the regular expressions here have no Unicode white space.
    spaces = (
        r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    )
    separators = spaces + r"""\"''.,()\-_\\/"""

    def keyword(c: str) -> str:
        return f"lower(regexp_replace({c}, '[{separators}]', '_', 'g'))"

    def grams(c: str) -> str:
        padded = f"'__' || {keyword(c)} || '__'"
        return f"""CASE WHEN {c} IS NOT NULL THEN array_to_string(list_transform(
            range(1, length({keyword(c)}) + 3), lambda i: substring({padded}, i, 3)), ' ') END"""

    return {
        "e1_display_name": sql("""SELECT objectid, CASE WHEN typename IS NULL OR typename = '' THEN name
            ELSE concat_ws(' ', typename, name) END AS label FROM addr_obj"""),
        "e2_house_suffix": sql(f"SELECT objectid, {HOUSE_SUFFIX} AS suffix FROM houses"),
        "e3_apartment_suffix": sql("""SELECT objectid, ', кв. ' || number AS required,
            CASE WHEN number = '1' THEN '' ELSE ', кв. ' || number END AS optional FROM apartments"""),
        "e4_room_suffix": sql("""SELECT objectid, CASE WHEN number = '2' THEN '' ELSE ', пом. ' || number END AS suffix
            FROM rooms"""),
        "e5_path_ids": sql("""SELECT objectid, count(*) AS n_ids, arg_min(element, pos) AS first_id,
            arg_max(element, pos) AS last_id FROM mun_hierarchy JOIN step USING (path) GROUP BY objectid"""),
        "e6_path_steps": sql(
            "SELECT objectid, pos AS position, element AS element_id FROM mun_hierarchy JOIN step USING (path)"),
        "e7_path_elements": sql("SELECT path, element AS element_id FROM mun_hierarchy JOIN step USING (path)"),
        "e8_indented": sql("""SELECT a.objectid, repeat('  ', len(string_split(path, '.')) - 1) || name AS name_indented
            FROM place a JOIN live l ON a.objectid = l.objectid"""),
        "e9_house_type_name": sql(f"SELECT objectid, {HOUSE_TYPE_SQL} AS housetype_name FROM houses"),
        "e10_level_number": sql("SELECT objectid, name, CAST(level AS BIGINT) AS level_num FROM addr_obj"),
        "e11_under_prefix": sql("""SELECT path, CAST(path LIKE '1%' AS INT) AS by_text,
            CAST(path = '1' OR path LIKE '1.%' AS INT) AS by_step, CAST(path LIKE '1.%' AS INT) AS below
            FROM mun_hierarchy"""),
        "e12_contains_text": """SELECT doc_id, CAST(text ILIKE '%É%' AS INT) AS with_accent,
            CAST(text ILIKE '%the%' AND text ILIKE '%and%' AS INT) AS with_both FROM documents""",
        "e13_predicates": sql("""SELECT objectid, level_num FROM place
            WHERE (level_num BETWEEN 3 AND 7 OR level_num IN (1, 10)) AND level_num <= 8"""),
        "e14_or_not_found": sql("""SELECT m.objectid, coalesce(label, 'Адрес не найден') AS label
            FROM mun_hierarchy m LEFT JOIN place a ON m.objectid = a.objectid"""),
        "e15_array_append": sql("""SELECT objectid,
            objectid || '<' || coalesce(CAST(parentobjid AS VARCHAR), 'none') AS pair FROM mun_hierarchy"""),
        "e16_keyword": f"SELECT doc_id, {keyword('text')} AS keyword, {keyword('source')} AS source FROM documents",
        "e17_ngrams": f"""SELECT doc_id, string_agg(gram, ' ' ORDER BY pos) AS grams FROM (
              SELECT doc_id, pos, c || lead(c) OVER near || lead(c, 2) OVER near AS gram FROM (
                SELECT doc_id, unnest(string_split(padded, '')) AS c, generate_subscripts(string_split(padded, ''), 1) AS pos
                FROM (SELECT doc_id, '__' || {keyword('text')} || '__' AS padded FROM documents))
              WINDOW near AS (PARTITION BY doc_id ORDER BY pos)) GROUP BY doc_id""",
        "e17_ngrams_of_names": sql(f"SELECT objectid, {grams('name')} AS grams FROM addr_obj"),
    }


def joins() -> dict[str, str]:
    chain = hierarchy()["aq1_address_chain"]
    return {
        "j1_active_objects": sql("SELECT h.objectid, path FROM house h JOIN live l ON h.objectid = l.objectid"),
        "j2_parents": sql(f", {ON_STREET} SELECT objectid, street_name FROM on_street"),
        "j3_parent_rows": sql("""SELECT l.objectid, l.path, up.path AS parent_path
            FROM live l JOIN live up ON l.parentobjid = up.objectid"""),
        "j4_path_places": sql("""SELECT l.objectid, pos AS position, element AS element_id, label
            FROM live l JOIN placed p ON l.path = p.path"""),
        "j5_level_names": sql("SELECT objectid, level_name FROM place LEFT JOIN level_name USING (level_num)"),
        "j6_children": sql("""SELECT DISTINCT h.objectid AS level_10_objectid, a.objectid AS level_9_objectid
            FROM house h JOIN live l ON h.objectid = l.objectid JOIN live up ON l.parentobjid = up.objectid
              JOIN placed p ON up.path = p.path LEFT JOIN live c ON c.parentobjid = h.objectid
              LEFT JOIN (SELECT objectid FROM apartments WHERE isactual = 1) a ON c.objectid = a.objectid"""),
        "w1_numbered_places": sql("""SELECT row_number() OVER (ORDER BY name, objectid) AS num, objectid, name, typename
            FROM place WHERE level = '8'"""),
        "w2_chain_addresses": f"SELECT target_objectid, full_address FROM ({chain})",
    }


def sinks() -> dict[str, str]:
    rows = """SELECT doc_id AS id, text, CASE WHEN lang <> 'fr' THEN lang END AS mark, n_chars > 500 AS long,
          CAST(NULL AS DATE) AS day FROM documents
        UNION ALL SELECT event_id, props, 'a' || chr(92) || 'b''c' || chr(9) || 'd' || chr(13) || event_type,
          CAST(NULL AS BOOLEAN), DATE '2024-01-01' + CAST(event_id % 1000 AS INT) FROM events"""

    def lines(
        quote: str, separator: str, null: str, bits: tuple[str, str], escapes: list[tuple[str, str]], start: str = "''",
        end: str = "''",
    ) -> str:
        def value(c: str) -> str:
            if c == "long":
                return f"CASE WHEN long IS NULL THEN {null} WHEN long THEN {bits[1]} ELSE {bits[0]} END"
            text = f"CAST({c} AS VARCHAR)"
            for found, replacement in escapes if c in ("text", "mark") else []:
                text = f"replace({text}, {found}, {replacement})"
            return f"coalesce({quote} || {text} || {quote}, {null})"
        values = f" || {separator} || ".join(value(c) for c in ("id", "text", "mark", "long", "day"))
        return f"SELECT {start} || {values} || {end} AS line FROM ({rows})"

    backslash, apostrophe, double = "chr(92)", "chr(39)", "chr(34)"
    slashes = (backslash, f"{backslash} || {backslash}")
    quoted = (double, f"{backslash} || {double}")
    apostrophes = (apostrophe, f"{backslash} || {apostrophe}")
    doubled = (apostrophe, f"{apostrophe} || {apostrophe}")
    n = f"{backslash} || 'N'"
    controls = [(f"chr({code})", f"{backslash} || '{letter}'") for code, letter in ((13, "r"), (10, "n"), (9, "t"))]
    bits, postgres_bits = ("'0'", "'1'"), ("'''0'''", "'''1'''")
    opened = "chr(9) || '('"
    line = "chr(9) || '(' || concat_ws(', ', {}) || ')'".format

    def values(columns: list[str], quote: str, null: str) -> str:
        return ", ".join(f"coalesce({quote} || {c} || {quote}, {null})" for c in columns)

    numbers = ["objectid", "housenum", "addnum1", "addnum2", "housetype"]
    house = ["objectid", "objectguid", "housenum", "addnum1", "addnum2", "housetype", "isactual"]
    mysql = f""", lines AS (
          SELECT 'OBJECT_LEVELS' AS t, 'common' AS region, 0 AS batch, level AS id,
            {line(values(['level', 'name'], double, "'NULL'"))} AS line FROM object_levels
          UNION ALL SELECT 'HOUSES', region, (row_number() OVER (PARTITION BY region ORDER BY objectid) - 1) // 500, objectid,
            {line(values(house, double, "'NULL'"))} FROM houses {REGION_OF})
        SELECT {{}} 'INSERT INTO `' || t || '` (`' || CASE t WHEN 'HOUSES' THEN '{"`, `".join(house)}'
            ELSE 'level`, `name' END || '`) VALUES ' || chr(10) || string_agg(line, ',' || chr(10) ORDER BY id) AS line
        FROM lines GROUP BY t, region, batch"""
    by_region = f"SELECT region, {{}} AS row_count FROM houses {REGION_OF} GROUP BY region"
    return {
        "k1_csv_lines": lines(double, "','", n, bits, [slashes, quoted]),
        "k2_tsv_lines": lines("''", "chr(9)", n, bits, [slashes, *controls]),
        "k3_postgres_lines": lines(apostrophe, "', '", "'NULL'", postgres_bits, [slashes, apostrophes], opened, "')'"),
        "k3_postgres_standard_lines": lines(apostrophe, "', '", "'NULL'", postgres_bits, [doubled], opened, "')'"),
        "k4_mysql_lines": lines(double, "', '", "'NULL'", bits, [slashes, quoted], opened, "')'"),
        "k5_insert_statements": sql(f"""SELECT region, batch,
              'INSERT INTO "houses" ("{'", "'.join(numbers)}") VALUES ' || chr(10)
                || string_agg(line, ',' || chr(10) ORDER BY objectid) || ';' || chr(10) AS statement
            FROM (SELECT region, objectid, (row_number() OVER (PARTITION BY region ORDER BY objectid) - 1) // 500 AS batch,
                {line(values(numbers, apostrophe, "'NULL'"))} AS line FROM houses {REGION_OF}) GROUP BY region, batch"""),
        "k6_region_tree": sql(f"""SELECT 'OBJECT_LEVELS' AS "table", 'common' AS region,
              concat_ws(',', {values(['level', 'name'], double, n)}) AS line FROM object_levels
            UNION ALL SELECT 'HOUSES', region, concat_ws(',', {values(house, double, n)}) FROM houses {REGION_OF}"""),
        "k6_per_table": sql(mysql.format('t AS "table",')),
        "k6_per_region": sql(mysql.format("region,")),
        "k6_direct": sql(mysql.format("")),
        "k6_scanned_tables": sql(mysql.format("region,")),
        "k7_layouts": sql("""SELECT platform, layout, CASE WHEN inserts OR layout = 'region_tree' THEN n END AS n_rows
            FROM (VALUES ('csv', FALSE), ('tsv', FALSE), ('psql', TRUE), ('psql_standard', TRUE), ('mysql', TRUE)) p(platform, inserts),
              (VALUES ('direct'), ('per_region'), ('per_table'), ('region_tree')) l(layout), (SELECT count(*) AS n FROM houses)"""),
        "k8_load": sql(by_region.format("count(*)")),
        "k8_load_append": sql(by_region.format("2 * count(*)")),
    }


def sources() -> dict[str, str]:
    roots = "SELECT CAST(objectid AS VARCHAR) AS region FROM addr_obj WHERE level = '1'"
    asked = "(VALUES ('1'), ('15'), ('99')) v(region)"
    found = f"""SELECT t AS "table", region FROM ({roots}), (VALUES ('ADDR_OBJ'), ('MUN_HIERARCHY'), ('HOUSES')) v(t)"""
    some = f"{REGION_OF} WHERE region IN ('1', '15')"
    def row_text(table: str) -> str:
        values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in COLUMNS[table])
        region = "NULL" if table == "object_levels" else "CASE WHEN (id + id // 10) % 2 = 0 THEN '01' ELSE '77' END"
        return f"""SELECT '{table}' AS table_name, {region} AS region, concat_ws('|', {values}) AS row_text
            FROM ({_plain(DECLARED[table])})"""

    return {
        "s1_xml_scan": sql(f"SELECT houses.*, region FROM houses {REGION_OF}"),
        "s1_xml_scan_whole_files": sql(f"SELECT houses.*, region FROM houses {REGION_OF}"),
        "s1_xml_scan_sections": sql(
            f"SELECT houses.*, '50' AS region FROM houses WHERE (objectid // {RANGE}) % {len(SECTIONS)} = 0"),
        "s2_table_files": sql(f"{found} UNION ALL SELECT 'OBJECT_LEVELS', NULL"),
        "s3_file_problems": sql(f"""SELECT 'ROOMS' AS "table", region, CAST(0 AS BIGINT) AS n_files FROM ({roots})
            UNION ALL SELECT 'ROOM_TYPES', NULL, 0"""),
        "s3_empty_region": """SELECT t AS "table", '98' AS region, CAST(0 AS BIGINT) AS n_files
            FROM (VALUES ('ADDR_OBJ'), ('MUN_HIERARCHY'), ('HOUSES')) v(t)""",
        "s4_regions": sql(roots),
        "s4_region_folders": sql(f"{roots} UNION ALL SELECT '98'"),
        "s5_missing_regions": sql(f"SELECT region FROM {asked} WHERE region NOT IN ({roots})"),
        "s5_selected_regions": sql(f"SELECT region FROM {asked} WHERE region IN ({roots})"),
        "s6_multi_region_scan": sql("SELECT *, string_split(path, '.')[1] AS region FROM mun_hierarchy"),
        "s6_some_regions_scan": sql(f"SELECT addr_obj.*, region FROM addr_obj {some}"),
        "s7_common_scan": sql("SELECT * FROM object_levels"),
        "s8_selected_tables": sql(f"""SELECT 'object_levels' AS table_name, count(*) AS row_count FROM object_levels
            UNION ALL SELECT 'addr_obj', count(*) FROM addr_obj {some}
            UNION ALL SELECT 'houses', count(*) FROM houses {some}
            UNION ALL SELECT 'mun_hierarchy', count(*) FROM mun_hierarchy {some}"""),
        "s8_declared_tables": sql(" UNION ALL ".join(row_text(t) for t in DECLARED)),
        "s8_schema_documents": SCHEMA_DOCUMENTS,
    }


def oracle_sql() -> dict[str, str]:
    return quality() | expressions() | joins() | sinks() | sources()
