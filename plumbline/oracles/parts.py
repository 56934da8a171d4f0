"""Shared pieces of the expected-result SQL: the registry as common table expressions, in DuckDB's dialect."""

from plumbline.plans import driver_registry as registry, registry_rules as rules

DUCKDB = {
    "dmy": lambda d: f"strftime({d}, '%d.%m.%Y')",
    "slash": lambda d: f"strftime({d}, '%d/%m/%Y')",
    "iso": lambda d: f"strftime({d}, '%Y-%m-%d')",
    "after": lambda day, n: f"(DATE '{day}' + CAST({n} AS INTEGER))",
    "day": lambda t: f"CAST({t} AS DATE)",
}

NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def literal(v):
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def values(name, rows, columns):
    body = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return f"{name} AS (SELECT {casts} FROM (VALUES {body}) t({', '.join(columns)}))"


def long_export(ids=None, name="long"):
    parts = []
    for table, expressions in registry.value_expressions(DUCKDB).items():
        source = "lineitem JOIN orders ON l_orderkey = o_orderkey" if table == "lineitem" else table
        keys = [k.format(slash=DUCKDB["slash"]("o_orderdate")) for k in registry.KEYS[table]]
        shown = ", ".join(f"{k} AS {n}" for k, n in zip(keys, registry.KEY_NAMES))
        parts += [f"SELECT {shown}, '{i}' AS source_id, {e} AS source_value FROM {source}"
                  for i, e in expressions.items() if ids is None or i in ids]
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


DICTIONARY = values("dict", rules.DICTIONARY, rules.DICTIONARY_COLUMNS)
CODEBOOK = values("codes", rules.CODEBOOK, rules.CODEBOOK_COLUMNS)
FORM_ELEMENTS = values("form_elements", rules.FORM_ELEMENTS, rules.FORM_ELEMENT_COLUMNS)
CORE = values("core", rules.CORE, rules.CORE_COLUMNS)
DATE_RULES = values("date_rules", rules.DATE_RULES, rules.DATE_RULE_COLUMNS)
LONGITUDINAL_RULES = values("long_rules", rules.LONGITUDINAL_RULES, rules.LONGITUDINAL_COLUMNS)
IMPORT_RULES = values("import_rules", rules.IMPORT_RULES, rules.IMPORT_COLUMNS)
INSTANCES = values("instances", rules.INSTANCES, rules.INSTANCE_COLUMNS)
FORMULAS = values("formulas", rules.FORMULAS, rules.FORMULA_COLUMNS)
MAPPINGS = values("mappings", rules.MAPPINGS, rules.MAPPING_COLUMNS)
REPORT_TEXTS = values("texts", rules.REPORT_TEXTS, rules.REPORT_COLUMNS)


def number(x, comma=True):
    text = f"replace(trim({x}), ',', '.')" if comma else f"trim({x})"
    return f"CASE WHEN regexp_full_match({text}, '{NUMBER}') THEN TRY_CAST({text} AS DOUBLE) END"


def filled(x):
    return f"({x} IS NOT NULL AND trim({x}) <> '')"


def _bounded(d):
    return f"(CASE WHEN {d} BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN {d} END)"


def date_in(x, name):
    shape, pattern, prefix = {
        "DD.MM.YYYY": (r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}", "%d.%m.%Y", ""),
        "MM.YYYY": (r"[0-9]{1,2}\.[0-9]{4}", "%d.%m.%Y", "01."),
        "YYYY-MM-DD": (r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "%Y-%m-%d", ""),
        "DD/MM/YYYY": (r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "%d/%m/%Y", ""),
    }[name]
    text = f"concat('{prefix}', trim({x}))" if prefix else f"trim({x})"
    return _bounded(f"CASE WHEN regexp_full_match(trim({x}), '{shape}') THEN"
                    f" CAST(try_strptime({text}, '{pattern}') AS DATE) END")


def date_by_format(x, fmt):
    whens = " ".join(f"WHEN '{n}' THEN {date_in(x, n)}" for n in ("DD.MM.YYYY", "MM.YYYY", "YYYY-MM-DD"))
    return f"(CASE trim({fmt}) {whens} END)"


def date_any(x):
    return "coalesce(" + ", ".join(date_in(x, n) for n in ("DD.MM.YYYY", "DD/MM/YYYY", "YYYY-MM-DD")) + ")"


def percent(n, d, scale=2):
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE round_even(CAST({n} AS DOUBLE) / {d} * 100, {scale}) END)"


def with_(*ctes):
    return "WITH " + ", ".join(ctes) + " "


EXPECTED = f"""expected AS (
 SELECT v.patient_id AS PID, v.episode_name AS episode_date, v.form_id, v.version AS form_version, v.form_type,
  e.form_label, e.dataelement_urn, e.source_id, e.mandatory
 FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS patient_id, CAST(NULL AS VARCHAR) AS episode_name, '1' AS form_id,
   CAST(c_custkey % 3 AS VARCHAR) AS version, 'basic' AS form_type FROM customer WHERE c_custkey % 29 <> 0
  UNION ALL SELECT concat('Z', c_custkey), NULL, '1', '0', 'basic' FROM customer WHERE c_custkey % 31 = 0
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, '4', '0', 'basic' FROM customer WHERE c_custkey % 23 = 0
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%d/%m/%Y'), '2',
   CASE WHEN o_orderkey % 107 = 0 THEN '9' ELSE CAST(o_orderkey % 3 AS VARCHAR) END, 'longitudinal'
   FROM orders WHERE o_custkey % 29 <> 0
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%d/%m/%Y'), '3', '0', 'longitudinal'
   FROM orders WHERE o_custkey % 29 <> 0
 ) v LEFT JOIN form_elements e ON e.form_id = v.form_id AND e.form_version = v.version)"""

FLAGGED = f"""by_episode AS (
 SELECT PID, Episode_Date AS d, source_id, bool_or({filled('source_value')}) AS f FROM long GROUP BY ALL),
by_patient AS (SELECT PID, source_id, bool_or(f) AS f FROM by_episode GROUP BY ALL),
filled AS (
 SELECT e.*, coalesce(CASE WHEN e.form_type = 'basic' THEN p.f ELSE b.f END, false) AS is_filled,
  EXISTS (SELECT 1 FROM core c WHERE c.form_id = e.form_id
   AND regexp_replace(c.dataelement_urn, ':[0-9]+$', '') = regexp_replace(e.dataelement_urn, ':[0-9]+$', '')) AS is_core
 FROM expected e
 LEFT JOIN by_patient p ON p.PID = e.PID AND p.source_id = e.source_id
 LEFT JOIN by_episode b ON b.PID = e.PID AND b.source_id = e.source_id AND b.d IS NOT DISTINCT FROM e.episode_date
 WHERE e.PID IN (SELECT PID FROM long)),
flagged AS (
 SELECT *, bool_or(is_filled) OVER (PARTITION BY form_type, PID, form_id,
  CASE WHEN form_type = 'basic' THEN NULL ELSE episode_date END) AS form_has_any_value FROM filled),
present AS (SELECT * FROM flagged WHERE form_has_any_value)"""

COMPLETENESS = with_(long_export(), FORM_ELEMENTS, CORE, EXPECTED, FLAGGED)

# The element list and dictionary that the part table forms.
ELEMENT_LIST = """element_list AS (
 SELECT p_brand AS Form, concat(b, ':', p_size % 3) AS form_id,
  CASE WHEN CAST(b AS INTEGER) % 4 = 0 THEN 'Basic' ELSE 'Longitudinal' END AS form_type,
  CASE WHEN p_size % 4 = 0 THEN concat('urn:reg:record:', p_size % 10, ':1') END AS record_urn,
  CASE WHEN p_size % 4 = 0 THEN concat('Record ', p_size % 10) END AS record_designation,
  CASE WHEN p_size % 4 = 0 THEN 'True' END AS record_mandatory,
  CASE WHEN p_size % 8 = 0 THEN 'True' END AS record_repeatable,
  concat('urn:reg:dataelement:', p_size, ':1') AS dataelement_urn, p_name AS dataelement_designation,
  CAST(NULL AS VARCHAR) AS dataelement_definition,
  CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS dataelement_mandatory, 'False' AS dataelement_repeatable,
  CASE p_size % 6 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'FLOAT' WHEN 2 THEN 'DATE' WHEN 3 THEN 'enumerated'
   WHEN 4 THEN 'BOOLEAN' END AS data_type,
  CASE p_size % 6 WHEN 0 THEN CASE p_size % 24 WHEN 6 THEN concat('1<=X<', p_size) WHEN 12 THEN concat(p_size, '<X')
   WHEN 18 THEN concat('X<=', p_size) ELSE concat('X<', p_size) END WHEN 1 THEN 'X'
   WHEN 2 THEN CASE WHEN p_size % 4 = 0 THEN 'MM.YYYY' ELSE 'DD.MM.YYYY' END WHEN 3 THEN 'enumerated' END AS data_format,
  CAST(NULL AS VARCHAR) AS unit, p_partkey AS row_ord,
  concat('X_', b, '_', CASE WHEN p_size % 4 = 0 THEN CAST(p_size % 10 AS VARCHAR) ELSE '0' END, '_', p_size) AS source_id
 FROM (SELECT *, replace(p_brand, 'Brand#', '') AS b FROM part) t
 WHERE p_partkey % 97 <> 0),
part_dict AS (
 SELECT * FROM element_list QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY row_ord) = 1)"""

FORM_ITEMS = """items AS (
 SELECT concat('K', p_partkey) AS form_key, CAST(CAST(replace(p_brand, 'Brand#', '') AS INTEGER)
  + CASE WHEN CAST(replace(p_brand, 'Brand#', '') AS INTEGER) > 20 THEN 100 ELSE 0 END AS VARCHAR) AS form_id,
  CAST(p_size % 3 AS VARCHAR) AS form_version,
  CASE WHEN p_size % 2 = 0 AND p_name <> '' THEN p_name ELSE concat('Form ', p_brand) END AS form_label,
  CASE WHEN p_type = 'ECONOMY' THEN concat('urn:reg:record:', p_size % 10, ':1')
   ELSE concat('urn:reg:dataelement:', p_size, ':1') END AS urn,
  CASE WHEN p_type = 'ECONOMY' THEN 'record' ELSE 'dataelement' END AS type,
  p_name AS element_label, CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS mandatory,
  'false' AS repeatable, CAST(p_partkey AS VARCHAR) AS position FROM part)"""

PART_ELEMENTS = """known AS (SELECT split_part(form_id, ':', 1) AS form_id, dataelement_urn, record_urn, source_id FROM part_dict),
elements AS (
 SELECT i.form_key, i.form_id, i.form_version, i.form_label, i.type, CAST(NULL AS VARCHAR) AS record_urn,
  i.urn AS dataelement_urn, k.source_id, i.mandatory, i.repeatable, i.position,
  CASE WHEN k.source_id IS NULL THEN 'direct_unresolved' ELSE 'direct_resolved' END AS resolution_status
 FROM items i LEFT JOIN (SELECT DISTINCT form_id, dataelement_urn, source_id FROM known) k
  ON k.form_id = i.form_id AND k.dataelement_urn = i.urn
 WHERE i.type = 'dataelement' AND i.form_id IN (SELECT form_id FROM known)
 UNION ALL
 SELECT i.form_key, i.form_id, i.form_version, i.form_label, i.type, i.urn, k.dataelement_urn, k.source_id,
  i.mandatory, i.repeatable, i.position,
  CASE WHEN k.source_id IS NULL THEN 'record_unresolved' ELSE 'record_resolved' END
 FROM items i LEFT JOIN known k ON k.form_id = i.form_id AND k.record_urn = i.urn
 WHERE i.type = 'record' AND i.form_id IN (SELECT form_id FROM known))"""

ELEMENT_DOCS = """docs AS (
 SELECT CAST(p_size AS VARCHAR) AS dataelement_id, '1' AS dataelement_version,
  concat('urn:reg:dataelement:', p_size, ':1') AS dataelement_urn,
  CASE WHEN p_partkey % 5 = 0 THEN 'DRAFT' ELSE 'RELEASED' END AS status,
  CASE WHEN p_partkey % 7 <> 0 THEN 'en' END AS language,
  CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS dataelement_designation,
  CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS dataelement_definition,
  CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'enumerated' ELSE 'STRING' END AS datatype, p_type AS format,
  CASE WHEN p_size % 3 = 0 THEN 'SELECT_ONE_RADIO' END AS slots, p_brand, p_type, p_name FROM part)"""

WIDE = """wide AS (
 SELECT CAST(o_custkey AS VARCHAR) AS PID,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS Episode,
  strftime(o_orderdate, '%d/%m/%Y') AS Episode_Date, l_orderkey * 10 + l_linenumber AS row_ord,
  CASE WHEN o_custkey % 5 = 0 OR l_linenumber % 2 = 0 THEN NULL ELSE o_orderpriority END AS X_2_0_22,
  CASE WHEN l_linenumber = 3 OR l_orderkey % 7 = 0 THEN NULL ELSE l_returnflag END AS X_3_31_46,
  CASE WHEN l_linenumber > 4 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS X_3_31_41,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linestatus END AS X_3_31_47
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def basic_long(wide="wide"):
    return f"""basic_cells AS (SELECT PID, 'X_2_0_22' AS source_id, X_2_0_22 AS source_value, row_ord FROM {wide}),
basic_long AS (
 SELECT PID, 'basic' AS Episode, CAST(NULL AS VARCHAR) AS Episode_Date, '1' AS IX, source_id, source_value,
  min(row_ord) AS row_ord
 FROM (SELECT *, bool_or(source_value IS NOT NULL) OVER (PARTITION BY PID, source_id) AS any_value FROM basic_cells)
 WHERE source_value IS NOT NULL OR NOT any_value GROUP BY PID, source_id, source_value)"""


def longitudinal_long(wide="wide"):
    cells = " UNION ALL ".join(
        f"SELECT PID, Episode, Episode_Date, row_ord, '{c}' AS source_id, {c} AS source_value FROM {wide}"
        " WHERE Episode IS NOT NULL AND Episode_Date IS NOT NULL"
        for c in registry.WIDE_LONGITUDINAL)
    return f"""cells AS ({cells}),
marked AS (SELECT *, bool_or(source_value IS NOT NULL)
  OVER (PARTITION BY PID, Episode, Episode_Date, source_id) AS any_value FROM cells),
longitudinal_long AS (
 SELECT PID, Episode, Episode_Date, CAST(row_number() OVER (PARTITION BY PID, Episode, Episode_Date, source_id
   ORDER BY row_ord, source_value) AS VARCHAR) AS IX, source_id, source_value,
  CASE WHEN source_value IS NULL THEN min(row_ord) OVER (PARTITION BY PID, Episode, Episode_Date, source_id)
   ELSE row_ord END AS row_ord
 FROM marked WHERE source_value IS NOT NULL OR NOT any_value)"""
