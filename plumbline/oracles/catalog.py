"""Expected result of every registered query as DuckDB SQL over the same tables."""

from plumbline import fixed_values as fixed
from plumbline.oracles import parts as p
from plumbline.plans import registry_rules as rules

ORACLES = {}
LONG_COLUMNS = "PID, Episode, Episode_Date, IX, source_id, source_value, row_ord"

# Reshaping.

ORACLES["long_basic"] = p.with_(p.WIDE, p.basic_long()) + f"SELECT {LONG_COLUMNS} FROM basic_long"
ORACLES["long_longitudinal"] = p.with_(p.WIDE, p.longitudinal_long()) + f"SELECT {LONG_COLUMNS} FROM longitudinal_long"
# Rows of one order share its number, so a fill by row order is a fill by (order line key, any order within it):
# ties on row_ord carry the same episode.
ORACLES["long_union"] = p.with_(
    p.WIDE,
    """steps AS (SELECT PID, row_ord, max(Episode) AS e FROM wide GROUP BY ALL),
carried AS (SELECT PID, row_ord, last_value(e IGNORE NULLS) OVER (PARTITION BY PID ORDER BY row_ord
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM steps),
kept AS (SELECT w.* REPLACE (c.e AS Episode) FROM wide w JOIN carried c USING (PID, row_ord)
 WHERE coalesce(X_2_0_22, X_3_31_46, X_3_31_41, X_3_31_47) IS NOT NULL)""",
    p.basic_long("kept"), p.longitudinal_long("kept"),
) + f"SELECT {LONG_COLUMNS} FROM basic_long UNION ALL SELECT {LONG_COLUMNS} FROM longitudinal_long"
ORACLES["ffill_episode_context"] = """
SELECT CAST(user_id AS VARCHAR) AS PID, event_id,
 last_value(CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END IGNORE NULLS) OVER w AS Episode,
 last_value(CASE WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d') END IGNORE NULLS) OVER w AS Episode_Date
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
ORACLES["drop_test_and_no_data"] = """
SELECT CAST(c_custkey AS VARCHAR) AS PID,
 CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat('Site ', c_nationkey) END AS Location,
 CASE WHEN c_custkey % 4 = 3 THEN c_mktsegment END AS X_1_0_11
FROM customer WHERE c_custkey % 17 <> 0 AND c_custkey % 19 <> 0"""
ORACLES["keep_rows_with_values"] = """
SELECT CAST(c_custkey AS VARCHAR) AS PID, c_mktsegment AS X_1_0_11 FROM customer WHERE c_custkey % 4 = 3"""
ORACLES["value_columns"] = p.with_(p.DICTIONARY) + """
SELECT lower(form_type) AS form_type,
 count(*) FILTER (source_id IN ('X_2_0_22', 'X_3_31_46', 'X_3_31_41', 'X_3_31_47')) AS n_present,
 count(*) FILTER (source_id NOT IN ('X_2_0_22', 'X_3_31_46', 'X_3_31_41', 'X_3_31_47')) AS n_missing,
 (SELECT count(*) FROM lineitem) AS n_rows
FROM dict GROUP BY 1"""

# Value conformance.

VALUE = p.with_(p.long_export(), p.DICTIONARY, p.CODEBOOK, f"""checked AS (
 SELECT l.*, d.dataelement_designation, d.data_format, upper(trim(d.data_type)) AS kind, trim(l.source_value) AS v,
  d.dataelement_urn, coalesce(trim(d.slots), '') AS slot,
  lower(coalesce(d.record_repeatable, '')) = 'true' OR lower(coalesce(d.dataelement_repeatable, '')) = 'true' AS repeats
 FROM long l JOIN dict d ON d.source_id = l.source_id WHERE {p.filled('l.source_value')}),
judged AS (
 SELECT *, CASE kind
  WHEN 'INTEGER' THEN regexp_full_match(v, '[+-]?[0-9]+')
  WHEN 'FLOAT' THEN ({p.number('v')}) IS NOT NULL
  WHEN 'BOOLEAN' THEN upper(v) IN ('TRUE', 'FALSE')
  WHEN 'DATE' THEN {p.date_by_format('v', 'data_format')} IS NOT NULL
  WHEN 'ENUMERATED' THEN EXISTS (SELECT 1 FROM codes c WHERE c.dataelement_urn = checked.dataelement_urn AND trim(c.pv_value) = v)
  END AS good FROM checked),
single AS (
 SELECT *, count(*) OVER (PARTITION BY PID, Episode, source_id) AS n FROM checked
 WHERE kind = 'ENUMERATED' AND slot IN ('', 'SELECT_ONE_RADIO') AND NOT repeats)""")


def _value_rows(kind):
    rule_id, rule_type, expected = next(r[1:] for r in fixed.VALUE_RULES if r[0] == kind)
    shown = f"'{expected}'" if kind != "DATE" else f"concat('{expected}', coalesce(data_format, 'nan'))"
    return f"""SELECT PID, Episode_Date, source_id, dataelement_designation, source_value, '{rule_id}' AS rule_id,
 '{rule_type}' AS rule_type, {shown} AS expected, source_value AS observed
FROM judged WHERE kind = '{kind}' AND NOT good"""


SINGLE_ROWS = f"""SELECT PID, Episode_Date, source_id, dataelement_designation, source_value,
 '{fixed.SINGLE_CHOICE_RULE[0]}' AS rule_id, '{fixed.SINGLE_CHOICE_RULE[1]}' AS rule_type,
 '{fixed.SINGLE_CHOICE_RULE[2]}' AS expected, CAST(n AS VARCHAR) AS observed FROM single WHERE n > 1"""
for _name, _kind in (("value_integer", "INTEGER"), ("value_float", "FLOAT"), ("value_boolean", "BOOLEAN"),
                     ("value_date_format", "DATE"), ("value_permissible", "ENUMERATED")):
    ORACLES[_name] = VALUE + _value_rows(_kind)
ORACLES["value_single_choice"] = VALUE + SINGLE_ROWS
ORACLES["value_violations"] = VALUE + " UNION ALL ".join(
    [_value_rows(k) for k, *_ in fixed.VALUE_RULES] + [SINGLE_ROWS])
VALUE_SUMMARY = " UNION ALL ".join(
    [f"SELECT '{t}' AS rule_type, '{r}' AS rule_id, count(*) AS assessed_elements,"
     f" count(*) FILTER (NOT good) AS total_violations FROM judged WHERE kind = '{k}'"
     for k, r, t, _ in fixed.VALUE_RULES]
    + [f"SELECT '{fixed.SINGLE_CHOICE_RULE[1]}', '{fixed.SINGLE_CHOICE_RULE[0]}',"
       " count(DISTINCT (PID, Episode, source_id)), count(*) FILTER (n > 1) FROM single"])
ORACLES["value_summary"] = VALUE + VALUE_SUMMARY
ORACLES["enriched_export"] = p.with_(p.long_export(), p.DICTIONARY) + """
SELECT l.source_id, d.data_type, d.data_format, d.dataelement_designation, count(*) AS n_rows,
 count(l.source_value) AS n_values FROM long l LEFT JOIN dict d ON d.source_id = l.source_id GROUP BY 1, 2, 3, 4"""

# Ranges. The limits are written out per element, as a reader of the dictionary would.
ORACLES["range_parse"] = p.with_(p.ELEMENT_LIST) + """
SELECT data_format,
 CASE WHEN data_format LIKE '1<=X<%' THEN 1.0 WHEN data_format LIKE '%<X' THEN CAST(replace(data_format, '<X', '') AS DOUBLE)
  END::DOUBLE AS low,
 CASE WHEN data_format LIKE '1<=X<%' THEN true WHEN data_format LIKE '%<X' THEN false END AS low_included,
 CASE WHEN data_format LIKE '1<=X<%' THEN CAST(replace(data_format, '1<=X<', '') AS DOUBLE)
  WHEN data_format LIKE 'X<=%' THEN CAST(replace(data_format, 'X<=', '') AS DOUBLE)
  WHEN data_format LIKE 'X<%' THEN CAST(replace(data_format, 'X<', '') AS DOUBLE) END AS high,
 CASE WHEN data_format LIKE '1<=X<%' THEN false WHEN data_format LIKE 'X<=%' THEN true WHEN data_format LIKE 'X<%' THEN false
  END AS high_included, count(*) AS n_elements
FROM element_list WHERE data_type IN ('INTEGER', 'FLOAT') GROUP BY data_format, data_type"""
RANGE_TESTS = {
    "X_1_0_13": "n < 0 OR n >= 9000", "X_1_0_16": "n > 20", "X_2_0_23": "n <= 100",
    "X_3_31_41": "n < 1 OR n > 45", "X_3_31_42": "n > 50000", "X_3_31_43": "n < 0 OR n >= 0.1", "X_3_31_48": "n <= 0",
}
RANGE = p.with_(p.long_export(set(RANGE_TESTS)), p.DICTIONARY,
                f"numbers AS (SELECT *, {p.number('source_value')} AS n FROM long)",
                "ranged AS (SELECT *, CASE source_id "
                + " ".join(f"WHEN '{i}' THEN {t}" for i, t in RANGE_TESTS.items())
                + " END AS outside FROM numbers WHERE n IS NOT NULL)")
RANGE_ID, RANGE_TYPE, RANGE_TEXT = fixed.RANGE_VIOLATION_RULE
ORACLES["range_violations"] = RANGE + f"""
SELECT r.PID, r.Episode, r.Episode_Date, r.IX, r.source_id, r.source_value, upper(trim(d.data_type)) AS data_type,
 d.data_format, r.n AS numeric_value, '{RANGE_ID}' AS rule_id, '{RANGE_TYPE}' AS rule_type, '{RANGE_TEXT}' AS expected,
 r.source_value AS observed FROM ranged r JOIN dict d ON d.source_id = r.source_id WHERE outside"""
RANGE_SUMMARY = f"""SELECT '{RANGE_TYPE}' AS rule_type, '{fixed.RANGE_SUMMARY_RULE[0]}' AS rule_id,
 count(*) AS assessed_elements, count(*) FILTER (outside) AS total_violations FROM ranged"""
ORACLES["range_summary"] = RANGE + RANGE_SUMMARY

# Temporal plausibility.

DATE_IDS = {r[4] for r in rules.DATE_RULES}
FIRST_DATE = """{name} AS (SELECT PID, parsed AS {column} FROM dated WHERE source_id = '{id}' AND parsed IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY PID ORDER BY row_ord, parsed) = 1)"""
DATED = f"""dated AS MATERIALIZED (
 SELECT l.*, r.* EXCLUDE (source_id), {p.date_by_format('l.source_value', 'r.data_format')} AS parsed,
  {p.date_in('l.Episode_Date', 'DD/MM/YYYY')} AS episode_parsed
 FROM date_long l JOIN date_rules r ON r.source_id = l.source_id)"""
FIRST_VISIT = """{name} AS (SELECT PID, Episode, parsed AS reference FROM dated WHERE source_id = '{id}' AND parsed IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY PID, Episode ORDER BY row_ord, parsed) = 1)"""
#: Rule -> (tables of reference dates, one SELECT for each kind of comparison).
DATE_CHECKS = {
    "not_before_dob": ([FIRST_DATE.format(name="births", column="dob_parsed", id=rules.BIRTH_ID)], [
        """SELECT d.*, 'not_before_dob' AS rule_id, parsed < dob_parsed AS bad, dob_parsed AS ref, CAST(NULL AS VARCHAR) AS ref_id
 FROM dated d JOIN births USING (PID) WHERE lower(trim(notBeforeDOB)) = 'true' AND parsed IS NOT NULL"""]),
    "not_after_death": ([FIRST_DATE.format(name="deaths", column="death_parsed", id=rules.DEATH_ID)], [
        """SELECT d.*, 'not_after_death' AS rule_id, parsed > death_parsed AS bad, death_parsed AS ref, CAST(NULL AS VARCHAR) AS ref_id
 FROM dated d JOIN deaths USING (PID) WHERE lower(trim(notAfterDeath)) = 'true' AND parsed IS NOT NULL"""]),
    "not_in_future": ([], [
        f"""SELECT d.*, 'not_in_future' AS rule_id, parsed > DATE '{rules.AS_OF}' AS bad, CAST(NULL AS DATE) AS ref,
 CAST(NULL AS VARCHAR) AS ref_id FROM dated d WHERE lower(trim(notFuture)) = 'true' AND parsed IS NOT NULL"""]),
    "not_after_episode": ([], [
        """SELECT d.*, 'not_after_episode' AS rule_id, parsed > episode_parsed AS bad, episode_parsed AS ref,
 CAST(NULL AS VARCHAR) AS ref_id FROM dated d
 WHERE lower(trim(notAfterEpisode)) = 'true' AND parsed IS NOT NULL AND episode_parsed IS NOT NULL"""]),
    "not_before_variable": ([
        FIRST_DATE.format(name="consents", column="reference", id="X_1_0_15"), FIRST_VISIT.format(name="visits", id="X_2_0_24"),
    ], [
        """SELECT d.*, 'not_before_variable' AS rule_id, parsed < reference AS bad, reference AS ref, 'X_1_0_15' AS ref_id
 FROM dated d JOIN consents USING (PID) WHERE source_id IN ('X_1_0_14', 'X_1_0_17', 'X_2_0_24') AND parsed IS NOT NULL""",
        """SELECT d.*, 'not_before_variable' AS rule_id, parsed < reference AS bad, reference AS ref, 'X_2_0_24' AS ref_id
 FROM dated d JOIN visits USING (PID, Episode) WHERE source_id = 'X_3_31_45' AND parsed IS NOT NULL""",
    ]),
    "not_after_variable": ([FIRST_VISIT.format(name="shipments", id="X_3_31_45")], [
        """SELECT d.*, 'not_after_variable' AS rule_id, parsed > reference AS bad, reference AS ref, 'X_3_31_45' AS ref_id
 FROM dated d JOIN shipments USING (PID, Episode) WHERE source_id = 'X_2_0_24' AND parsed IS NOT NULL"""]),
}


def _date_ctes(ids, *rule_ids):
    """CTEs for some rules alone: the values of the elements they read, their references and their checks."""
    references = [t for r in rule_ids for t in DATE_CHECKS[r][0]]
    checks = " UNION ALL ".join(c for r in rule_ids for c in DATE_CHECKS[r][1])
    return (p.long_export(ids, "date_long"), p.DATE_RULES, DATED, *references, f"date_checks AS ({checks})")


DATED_CTES = _date_ctes(DATE_IDS, *DATE_CHECKS)


def _date_rows(rule_id, extra="", ids=None):
    return p.with_(*_date_ctes(ids or DATE_IDS, rule_id)) + f"""SELECT PID, Episode, Episode_Date, IX, source_id, source_value, data_format,
 parsed AS source_value_parsed, rule_id, '{fixed.TEMPORAL_RULE_TYPE}' AS rule_type,
 '{dict(fixed.TEMPORAL_RULES)[rule_id]}' AS expected, CAST(parsed AS VARCHAR) AS observed{extra}
FROM date_checks WHERE bad"""


ORACLES["date_dob"] = _date_rows("not_before_dob", ", ref AS dob_parsed")
ORACLES["date_after_death"] = _date_rows("not_after_death", ", ref AS death_parsed")
ORACLES["date_future"] = _date_rows("not_in_future")
ORACLES["date_episode"] = _date_rows("not_after_episode", ", ref AS episode_date_parsed")
ORACLES["date_before_variable"] = _date_rows(
    "not_before_variable", ", ref_id AS comparison_source_id, ref AS comparison_date_parsed")
ORACLES["date_after_variable"] = _date_rows(
    "not_after_variable", ", ref_id AS comparison_source_id, ref AS comparison_date_parsed", {"X_2_0_24", "X_3_31_45"})
DATE_SUMMARY = " UNION ALL ".join(
    f"SELECT '{fixed.TEMPORAL_RULE_TYPE}' AS rule_type, '{r}' AS rule_id, count(*) AS assessed_elements,"
    f" count(*) FILTER (bad) AS total_violations FROM date_checks WHERE rule_id = '{r}'" for r, _ in fixed.TEMPORAL_RULES)
ORACLES["date_summary"] = p.with_(*DATED_CTES) + DATE_SUMMARY

# Forms and completeness.

ORACLES["form_items"] = p.with_(p.FORM_ITEMS) + "SELECT * FROM items"
PART = p.with_(p.ELEMENT_LIST, p.FORM_ITEMS, p.PART_ELEMENTS)
ORACLES["form_elements_resolved"] = PART + "SELECT * FROM elements WHERE source_id IS NOT NULL"
ORACLES["form_elements_unresolved"] = PART + "SELECT * FROM elements WHERE source_id IS NULL"
EXPECTED = p.with_(p.FORM_ELEMENTS, p.EXPECTED)
ORACLES["expected_elements"] = EXPECTED + """
SELECT PID, episode_date, form_id, form_version, form_type, dataelement_urn, source_id, mandatory FROM expected"""
ORACLES["form_versions_present"] = EXPECTED + "SELECT DISTINCT form_id, form_version FROM expected"
ORACLES["expected_summary"] = p.with_(
    p.ELEMENT_LIST, p.FORM_ITEMS, p.PART_ELEMENTS, p.FORM_ELEMENTS, p.EXPECTED,
) + " UNION ALL ".join(f"SELECT '{m}' AS metric, {q} AS value" for m, q in zip(fixed.EXPECTED_METRICS, (
    "(SELECT count(DISTINCT (form_id, form_version)) FROM items)", "(SELECT count(*) FROM items)",
    "(SELECT count(*) FROM items WHERE type = 'dataelement')", "(SELECT count(*) FROM items WHERE type = 'record')",
    "(SELECT count(source_id) FROM elements)", "(SELECT count(*) FROM elements WHERE source_id IS NULL)",
    "(SELECT count(source_id) FROM elements)", "(SELECT count(*) FROM expected WHERE form_type = 'basic')",
    "(SELECT count(*) FROM expected WHERE form_type = 'longitudinal')", "(SELECT count(*) FROM expected)")))
ORACLES["completeness_rows"] = p.COMPLETENESS + """
SELECT PID, episode_date, form_id, form_version, form_type, source_id, is_filled, is_core, form_has_any_value FROM present"""


def _tier(metric, where):
    mandatory = "lower(trim(mandatory)) IN ('true', '1', 'yes')"
    cells = ", ".join(
        f"{p.percent(f'count(*) FILTER (is_filled AND {c})', f'count(*) FILTER ({c})')} AS {n}_completeness_percent"
        for n, c in (("general", "true"), ("core", "is_core"), ("mandatory", mandatory)))
    return f"SELECT '{metric}' AS metric, {cells} FROM present WHERE {where}"


ORACLES["completeness_summary"] = p.COMPLETENESS + " UNION ALL ".join(
    _tier(metric, "true" if tier == "all" else f"form_type = '{tier}'") for tier, metric in fixed.COMPLETENESS_METRICS)
INSTANCES = p.COMPLETENESS + """, form_instances AS (
 SELECT form_type, PID, episode_date, form_id, form_version, bool_or(is_filled) AS form_has_any_value,
  count(source_id) AS n_expected_elements, count(*) FILTER (is_filled) AS n_filled_elements
 FROM flagged GROUP BY ALL) """
ORACLES["form_presence_summary"] = INSTANCES + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, d AS denominator_n, n AS numerator_n, {p.percent('n', 'd')} AS percent"
    f" FROM (SELECT count(*) AS d, count(*) FILTER ({c}) AS n FROM form_instances WHERE {w})"
    for m, c, w in zip(fixed.PRESENCE_METRICS,
                       ("form_has_any_value", "NOT form_has_any_value", "NOT form_has_any_value"),
                       ("true", "form_type = 'basic'", "form_type = 'longitudinal'")))
ORACLES["empty_basic_forms"] = INSTANCES + """
SELECT PID, form_id, form_version, form_has_any_value, n_expected_elements, n_filled_elements
FROM form_instances WHERE form_type = 'basic' AND NOT form_has_any_value"""
ORACLES["empty_longitudinal_forms"] = INSTANCES + """
SELECT PID, episode_date, form_id, form_version, form_has_any_value, n_expected_elements, n_filled_elements
FROM form_instances WHERE form_type = 'longitudinal' AND NOT form_has_any_value"""


def _level(keys, counted, extra=""):
    return p.COMPLETENESS + f"""SELECT {keys}{extra}, g AS general_expected_n, gf AS general_filled_n,
 {p.percent('gf', 'g')} AS general_completeness_percent, c AS core_expected_n, cf AS core_filled_n,
 {p.percent('cf', 'c')} AS core_completeness_percent
FROM (SELECT {keys}, count({counted}) AS g, count(*) FILTER (is_filled) AS gf,
 count({counted}) FILTER (is_core) AS c, count(*) FILTER (is_core AND is_filled) AS cf,
 count(DISTINCT PID) AS n_patients, min(form_label) AS form_label FROM present GROUP BY {keys})"""


ORACLES["completeness_per_patient"] = _level("PID", "source_id")
ORACLES["completeness_per_form"] = _level("form_id", "source_id", ", form_label, n_patients")
ORACLES["completeness_per_form_version"] = _level("form_id, form_version", "source_id", ", n_patients")
ORACLES["completeness_per_element"] = _level("source_id", "PID")

# Calculations, written out as SQL.

CALCULATION_CTES = (
    p.long_export({"X_3_31_41", "X_3_31_42", "X_3_31_43", "X_3_31_44", "X_3_31_48"}, "calc_long"),
    f"""calc_values AS (SELECT *, {p.number('source_value')} AS n FROM calc_long),
inputs AS (
 SELECT PID, Episode_Date, IX,
  max(n) FILTER (source_id = 'X_3_31_41') AS quantity, max(n) FILTER (source_id = 'X_3_31_42') AS price,
  max(n) FILTER (source_id = 'X_3_31_43') AS discount, max(n) FILTER (source_id = 'X_3_31_44') AS tax,
  count(DISTINCT n) FILTER (source_id = 'X_3_31_41') AS nq, count(DISTINCT n) FILTER (source_id = 'X_3_31_42') AS np,
  count(DISTINCT n) FILTER (source_id = 'X_3_31_43') AS nd, count(DISTINCT n) FILTER (source_id = 'X_3_31_44') AS nt
 FROM calc_values GROUP BY PID, Episode_Date, IX),
cases AS (
 SELECT v.PID, v.Episode_Date, v.IX, v.n AS stored, 'NET_line' AS id, 'NET' AS type, 'Net' AS label, v.source_id,
  0.1::DOUBLE AS tolerance, CAST(format('{{:.2f}}', price * (1 - discount) * (1 + tax)) AS DOUBLE) AS expected,
  concat('discount=', discount::DECIMAL(18,2), ';price=', price::DECIMAL(18,2), ';tax=', tax::DECIMAL(18,2)) AS used
 FROM calc_values v JOIN inputs i ON v.PID = i.PID AND v.Episode_Date IS NOT DISTINCT FROM i.Episode_Date AND v.IX = i.IX
 WHERE v.source_id = 'X_3_31_48' AND v.n IS NOT NULL AND np = 1 AND nd = 1 AND nt = 1
 UNION ALL
 SELECT v.PID, v.Episode_Date, v.IX, v.n, 'BULK_line', 'BULK', 'Quantity', v.source_id, 25,
  round_even(10 * ln(greatest(quantity, 1)) + abs(tax - discount) ** 2, 0),
  concat('discount=', discount::DECIMAL(18,2), ';quantity=', quantity::DECIMAL(18,2), ';tax=', tax::DECIMAL(18,2))
 FROM calc_values v JOIN inputs i ON v.PID = i.PID AND v.Episode_Date IS NOT DISTINCT FROM i.Episode_Date AND v.IX = i.IX
 WHERE v.source_id = 'X_3_31_41' AND v.n IS NOT NULL AND nq = 1 AND nd = 1 AND nt = 1
 UNION ALL
 SELECT v.PID, v.Episode_Date, v.IX, v.n, 'INVERSE_line', 'INVERSE', 'Tax', v.source_id, 20,
  1 / nullif(tax, 0) - least(discount, 0.05),
  concat('discount=', discount::DECIMAL(18,2), ';tax=', tax::DECIMAL(18,2))
 FROM calc_values v JOIN inputs i ON v.PID = i.PID AND v.Episode_Date IS NOT DISTINCT FROM i.Episode_Date AND v.IX = i.IX
 WHERE v.source_id = 'X_3_31_44' AND v.n IS NOT NULL AND nd = 1 AND nt = 1),
judged_cases AS (SELECT *, abs(stored - expected) > tolerance AS bad FROM cases WHERE expected IS NOT NULL)""",
    p.FORMULAS,
)
CALCULATION = p.with_(*CALCULATION_CTES)
CALCULATION_ROWS = """SELECT PID, Episode_Date AS episode_date, id AS calculation_id, type AS calculation_type,
 label AS score_label, source_id AS score_source_id, IX, CAST(stored AS DECIMAL(18,2)) AS stored_value,
 CAST(expected AS DECIMAL(18,4)) AS expected_value, judged_cases.tolerance, f.formula_expression, used AS input_values,
 CASE WHEN bad THEN 'violation' ELSE 'pass' END AS status, bad AS violation
FROM judged_cases JOIN formulas f ON f.calculation_type = type"""
ORACLES["calc_results"] = CALCULATION + CALCULATION_ROWS
ORACLES["calc_violations"] = CALCULATION + CALCULATION_ROWS + " WHERE bad"
CALCULATION_SUMMARY = " UNION ALL ".join(
    f"SELECT '{t}' AS rule_type, '{i}' AS rule_id, count(*) AS assessed_elements,"
    f" count(*) FILTER (bad) AS total_violations FROM judged_cases WHERE id = '{i}'"
    for i, t in (("NET_line", fixed.CALCULATION_RULE_TYPE), ("BULK_line", fixed.CALCULATION_RULE_TYPE),
                 ("INVERSE_line", fixed.CALCULATION_RULE_TYPE), ("NO_formula", fixed.CALCULATION_SKIPPED_RULE_TYPE),
                 ("NO_mapping", fixed.CALCULATION_SKIPPED_RULE_TYPE)))
ORACLES["calc_summary"] = CALCULATION + CALCULATION_SUMMARY

# Imports.

IMPORT_CTES = (
    p.long_export({r[2] for r in rules.IMPORT_RULES} | {r[4] for r in rules.IMPORT_RULES}, "import_long"),
    p.IMPORT_RULES,
    f"""one_value AS MATERIALIZED (
 SELECT PID, Episode_Date AS episode_date, source_id, CASE count(DISTINCT source_value) WHEN 0 THEN NULL
  WHEN 1 THEN min(source_value) ELSE '{fixed.MULTIPLE_VALUES}' END AS v FROM import_long GROUP BY ALL),
one_basic AS MATERIALIZED (
 SELECT PID, source_id, CASE count(DISTINCT source_value) WHEN 0 THEN NULL
  WHEN 1 THEN min(source_value) ELSE '{fixed.MULTIPLE_VALUES}' END AS v
 FROM import_long WHERE source_id LIKE 'X_1_%' GROUP BY ALL),
import_pairs AS (
 SELECT t.PID, t.episode_date, r.*, t.v AS target_value, CASE WHEN r.source_source_id LIKE 'X_1_%' THEN b.v ELSE s.v END AS source_value
 FROM one_value t JOIN import_rules r ON r.target_source_id = t.source_id
 LEFT JOIN one_value s ON s.PID = t.PID AND s.episode_date IS NOT DISTINCT FROM t.episode_date AND s.source_id = r.source_source_id
 LEFT JOIN one_basic b ON b.PID = t.PID AND b.source_id = r.source_source_id),
import_outcomes AS (
 SELECT *, CASE WHEN source_value IS NULL THEN 'missing' WHEN source_value = '{fixed.MULTIPLE_VALUES}' THEN 'multiple_source'
  WHEN target_value = '{fixed.MULTIPLE_VALUES}' THEN 'multiple_target'
  WHEN {p.number('source_value')} IS NOT NULL AND {p.number('target_value')} IS NOT NULL
   THEN CASE WHEN {p.number('source_value')} = {p.number('target_value')} THEN 'equal' ELSE 'different' END
  WHEN trim(source_value) = trim(target_value) THEN 'equal' ELSE 'different' END AS outcome
 FROM import_pairs WHERE target_value IS NOT NULL)""",
)
IMPORT = p.with_(*IMPORT_CTES)
ORACLES["import_violations"] = IMPORT + """
SELECT PID, episode_date, rule_id, source_label, target_label, source_source_id, target_source_id, source_value,
 target_value, true AS violation FROM import_outcomes WHERE outcome = 'different'"""
IMPORT_COUNTS = """
SELECT r.rule_id, r.source_label, r.target_label, r.source_source_id, r.target_source_id,
 count(*) FILTER (outcome IN ('equal', 'different')) AS assessed_elements,
 count(*) FILTER (outcome = 'different') AS total_violations,
 count(*) FILTER (outcome = 'missing') AS n_skipped_missing_source,
 count(*) FILTER (outcome = 'multiple_source') AS n_skipped_multiple_source,
 count(*) FILTER (outcome = 'multiple_target') AS n_skipped_multiple_target
FROM import_rules r LEFT JOIN import_outcomes o ON o.rule_id = r.rule_id
GROUP BY r.rule_id, r.source_label, r.target_label, r.source_source_id, r.target_source_id"""
ORACLES["import_summary"] = IMPORT + IMPORT_COUNTS
ORACLES["import_patient_summary"] = IMPORT + """
SELECT PID, count(*) AS n_violations, count(DISTINCT rule_id) AS n_failed_rules,
 string_agg(DISTINCT rule_id, ', ' ORDER BY rule_id) AS failed_rules
FROM import_outcomes WHERE outcome = 'different' GROUP BY PID"""

# Longitudinal plausibility.

LONGITUDINAL_CTES = (
    p.long_export({r[1] for r in rules.LONGITUDINAL_RULES}, "change_long"), p.LONGITUDINAL_RULES,
    f"""change_rows AS (
 SELECT l.PID, l.source_id, trim(l.source_value) AS v, l.row_ord, {p.date_any('l.Episode_Date')} AS d,
  r.rule_id, r.variable_label, r.value_type, CAST(r.allowed_variation_percent AS DOUBLE) AS allowed
 FROM change_long l JOIN long_rules r ON r.source_id = l.source_id WHERE {p.filled('l.source_value')}),
spans AS (
 SELECT PID, source_id, min(d) AS first_d, max(d) AS last_d, count(DISTINCT d) AS n_d FROM change_rows
 WHERE d IS NOT NULL GROUP BY ALL),
categorical AS (
 SELECT PID, source_id, CAST(count(DISTINCT v) - 1 AS DOUBLE) AS variation, NULL AS lo, NULL AS hi,
  count(*) AS n_rows, count(DISTINCT d) AS n_valid FROM change_rows
 WHERE d IS NOT NULL AND lower(value_type) IN ('enumerated', 'radio', 'multiple-choice', 'dropdown', 'date') GROUP BY ALL),
categorical_values AS (
 SELECT PID, source_id, v AS value, min((d, row_ord)) AS place FROM change_rows
 WHERE d IS NOT NULL AND lower(value_type) IN ('enumerated', 'radio', 'multiple-choice', 'dropdown', 'date') GROUP BY ALL),
numeric_rows AS (
 SELECT *, {p.number('v', comma=False)} AS n FROM change_rows
 WHERE d IS NOT NULL AND lower(value_type) IN ('float', 'integer', 'numeric')),
numeric_groups AS (
 SELECT PID, source_id, CASE WHEN min(n) = 0 AND max(n) = 0 THEN 0.0 WHEN min(n) = 0 THEN CAST('inf' AS DOUBLE)
   ELSE (max(n) - min(n)) / abs(min(n)) * 100 END AS variation,
  min(n) AS lo, max(n) AS hi, count(n) AS n_rows, count(DISTINCT d) FILTER (n IS NOT NULL) AS n_valid
 FROM numeric_rows GROUP BY ALL),
dated_rows AS (
 SELECT * FROM (SELECT *, {p.date_any('v')} AS value FROM change_rows WHERE d IS NOT NULL AND value_type = 'date_increasing')
 WHERE value IS NOT NULL),
steps AS (
 SELECT *, lag(value) OVER (PARTITION BY PID, source_id ORDER BY d, row_ord, value) AS before FROM dated_rows),
increasing AS (
 SELECT PID, source_id, CAST(count(*) FILTER (value < before) AS DOUBLE) AS variation, CAST(min(value) AS VARCHAR) AS lo,
  CAST(max(value) AS VARCHAR) AS hi, count(*) AS n_rows, count(DISTINCT d) AS n_valid FROM steps GROUP BY ALL)""",
)
LONGITUDINAL = p.with_(*LONGITUDINAL_CTES)


def _longitudinal_rows(groups, listed, number=False):
    cell = "CAST(g.{0} AS DECIMAL(18,2))" if number else "CAST(g.{0} AS VARCHAR)"
    return LONGITUDINAL + f"""SELECT r.rule_id, g.PID, g.source_id, r.variable_label, r.value_type,
 CAST(r.allowed_variation_percent AS DOUBLE) AS allowed_variation_percent,
 CAST(g.variation AS DECIMAL(18,4)) AS observed_variation, {cell.format('lo')} AS min_value, {cell.format('hi')} AS max_value,
 s.first_d AS first_episode_date, s.last_d AS last_episode_date, s.n_d AS n_episode_dates,
 g.n_rows AS n_rows_checked
FROM {groups} g JOIN spans s USING (PID, source_id) JOIN long_rules r USING (source_id)
JOIN ({listed}) t USING (PID, source_id)
WHERE g.n_valid >= 2 AND NOT g.variation <= CAST(r.allowed_variation_percent AS DOUBLE)"""


ORACLES["long_enumerated"] = _longitudinal_rows(
    "categorical",
    "SELECT PID, source_id, string_agg(value, ' | ' ORDER BY place, value) AS text FROM categorical_values GROUP BY ALL")
ORACLES["long_numeric"] = _longitudinal_rows(
    "numeric_groups",
    "SELECT PID, source_id, string_agg(DISTINCT v, ' | ' ORDER BY v) AS text FROM numeric_rows WHERE n IS NOT NULL GROUP BY ALL",
    number=True)
ORACLES["long_date_increasing"] = _longitudinal_rows(
    "increasing",
    "SELECT PID, source_id, string_agg(CAST(value AS VARCHAR), ' | ' ORDER BY d, row_ord, value) AS text"
    " FROM dated_rows GROUP BY ALL")
LONGITUDINAL_SUMMARY = f"""SELECT '{fixed.LONGITUDINAL_RULE_TYPE}' AS rule_type, r.rule_id, count(g.PID) AS assessed_elements,
 count(*) FILTER (NOT g.variation <= CAST(r.allowed_variation_percent AS DOUBLE)) AS total_violations
FROM long_rules r LEFT JOIN (
 SELECT PID, source_id, variation, n_valid FROM categorical UNION ALL SELECT PID, source_id, variation, n_valid FROM numeric_groups
 UNION ALL SELECT PID, source_id, variation, n_valid FROM increasing) g ON g.source_id = r.source_id AND g.n_valid >= 2
GROUP BY r.rule_id"""
ORACLES["long_summary"] = LONGITUDINAL + LONGITUDINAL_SUMMARY
ORACLES["long_observed_values"] = LONGITUDINAL + """, bad AS (
 SELECT g.PID, g.source_id, r.rule_id FROM (
  SELECT PID, source_id, variation, n_valid FROM categorical UNION ALL SELECT PID, source_id, variation, n_valid FROM numeric_groups
  UNION ALL SELECT PID, source_id, variation, n_valid FROM increasing) g JOIN long_rules r USING (source_id)
 WHERE g.n_valid >= 2 AND NOT g.variation <= CAST(r.allowed_variation_percent AS DOUBLE)),
listed AS (
 SELECT PID, source_id, d AS episode_date, row_ord, CAST(value AS VARCHAR) AS value FROM dated_rows
 UNION ALL SELECT DISTINCT PID, source_id, CAST(NULL AS DATE), CAST(NULL AS BIGINT), v FROM numeric_rows WHERE n IS NOT NULL
 UNION ALL SELECT PID, source_id, place[1], place[2], value FROM categorical_values)
SELECT listed.*, rule_id FROM listed JOIN bad USING (PID, source_id)"""

# Relational conformance.

RELATIONAL_CTES = (
    p.long_export(), p.DICTIONARY, p.FORM_ELEMENTS, p.EXPECTED,
    f"""rel_sources AS (SELECT DISTINCT source_id, source_id NOT IN (SELECT source_id FROM dict) AS bad FROM long),
export_pids AS (SELECT DISTINCT PID FROM long), expected_pids AS (SELECT DISTINCT PID FROM expected),
rel_pids AS (
 SELECT coalesce(a.PID, b.PID) AS PID, a.PID IS NULL OR b.PID IS NULL AS bad, b.PID IS NULL AS only_export
 FROM export_pids a FULL JOIN expected_pids b ON a.PID = b.PID),
recorded AS (
 SELECT DISTINCT PID, Episode_Date, source_id FROM long
 WHERE {p.filled('source_value')} AND PID IN (SELECT PID FROM expected_pids)),
rel_elements AS (
 SELECT *, CASE WHEN Episode_Date IS NULL
  THEN (PID, source_id) NOT IN (SELECT (PID, source_id) FROM expected WHERE form_type = 'basic' AND source_id IS NOT NULL)
  ELSE (PID, Episode_Date, source_id) NOT IN (SELECT (PID, episode_date, source_id) FROM expected
   WHERE form_type = 'longitudinal' AND source_id IS NOT NULL) END AS bad FROM recorded),
rel_versions AS (
 SELECT DISTINCT form_id, form_version,
  (form_id, form_version) NOT IN (SELECT (form_id, form_version) FROM form_elements) AS bad FROM expected)""",
)
RELATIONAL = p.with_(*RELATIONAL_CTES)
RELATIONAL_TEXTS = {r[0]: r[1] for r in fixed.RELATIONAL_RULES}


def _relational_rows(rule_id, table, observed, **cells):
    shown = ", ".join(f"{cells.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}"
                      for c in ("PID", "Episode_Date", "source_id", "form_id", "form_version"))
    return RELATIONAL + f"""SELECT {shown}, '{rule_id}' AS rule_id, '{fixed.RELATIONAL_RULE_TYPE}' AS rule_type,
 '{RELATIONAL_TEXTS[rule_id]}' AS expected, {observed} AS observed FROM {table} WHERE bad"""


ORACLES["rel_source_id"] = _relational_rows("Source_id_exists", "rel_sources", "source_id", source_id="source_id")
ORACLES["rel_pid_mapping"] = _relational_rows(
    "PID_mapping_conformance", "rel_pids",
    f"CASE WHEN only_export THEN '{fixed.PID_ONLY_IN_EXPORT}' ELSE '{fixed.PID_ONLY_IN_EXPECTED}' END", PID="PID")
ORACLES["rel_element_expected"] = _relational_rows(
    "Element_expected_for_patient", "rel_elements",
    "concat(PID, ' | ', coalesce(Episode_Date, 'basic'), ' | ', source_id)",
    PID="PID", Episode_Date="Episode_Date", source_id="source_id")
ORACLES["rel_form_version"] = _relational_rows(
    "Form_version_exists", "rel_versions", "concat(form_id, ' | version ', form_version)",
    form_id="form_id", form_version="form_version")
RELATIONAL_SUMMARY = " UNION ALL ".join(
    f"SELECT '{fixed.RELATIONAL_RULE_TYPE}' AS rule_type, '{r[0]}' AS rule_id, count(*) AS assessed_elements,"
    f" count(*) FILTER (bad) AS total_violations FROM {t}"
    for r, t in zip(fixed.RELATIONAL_RULES, ("rel_sources", "rel_pids", "rel_elements", "rel_versions")))
ORACLES["rel_summary"] = RELATIONAL + RELATIONAL_SUMMARY

# Report tables.


def _summaries():
    value = VALUE[len("WITH "):].rstrip()
    ranged = RANGE[len("WITH "):].rstrip().replace("long AS (", "range_long AS (", 1).replace("FROM long)", "FROM range_long)")
    dictionary = p.DICTIONARY + ", "
    ranged = ranged.replace(dictionary, "")
    relational = ", ".join(RELATIONAL_CTES[2:])
    ctes = [value, ranged, *DATED_CTES, *CALCULATION_CTES, *IMPORT_CTES, *LONGITUDINAL_CTES, relational]
    imports = (f"SELECT '{fixed.IMPORT_RULE_TYPE}' AS rule_type, rule_id, assessed_elements, total_violations"
               f" FROM ({IMPORT_COUNTS})")
    union = " UNION ALL ".join([VALUE_SUMMARY, RANGE_SUMMARY, DATE_SUMMARY, CALCULATION_SUMMARY, imports,
                                LONGITUDINAL_SUMMARY, RELATIONAL_SUMMARY])
    return ctes + [f"summaries AS ({union})"]


SUMMARIES = p.with_(*_summaries(), p.REPORT_TEXTS)
ORACLES["report_rates"] = SUMMARIES + """
SELECT s.rule_type, s.rule_id, s.assessed_elements, s.total_violations,
 CAST(CAST(s.total_violations AS DOUBLE) / nullif(s.assessed_elements, 0) * 100 AS DECIMAL(18,4)) AS violation_rate,
 coalesce(a.assessment_unit, b.assessment_unit) AS assessment_unit, coalesce(a.explanation, b.explanation) AS explanation
FROM summaries s LEFT JOIN texts a ON trim(a.rule_id) = s.rule_id
LEFT JOIN (SELECT trim(rule_type) AS t, arg_min(assessment_unit, explanation) AS assessment_unit,
 min(explanation) AS explanation FROM texts GROUP BY 1) b ON b.t = s.rule_type"""
ORACLES["report_sections"] = SUMMARIES + """
SELECT section, count(*) AS n_checks, sum(assessed_elements) AS total_assessed, sum(total_violations) AS total_violations,
 CAST(CAST(sum(total_violations) AS DOUBLE) / nullif(sum(assessed_elements), 0) * 100 AS DECIMAL(18,4)) AS pooled_violation_rate
FROM (SELECT *, CASE WHEN rule_type = 'computational_conformance' THEN 'calculation_check' ELSE rule_type END AS section FROM summaries)
WHERE section IN ('calculation_check', 'import_check', 'longitudinal_plausibility', 'temporal_plausibility') GROUP BY section"""
ORACLES["report_relational"] = RELATIONAL + f""", summary AS ({RELATIONAL_SUMMARY})
SELECT rule_id, CASE rule_id {' '.join(f"WHEN '{r[0]}' THEN '{r[2]}'" for r in fixed.RELATIONAL_RULES)} END AS "check",
 CASE rule_id {' '.join(f"WHEN '{r[0]}' THEN '{r[3]}'" for r in fixed.RELATIONAL_RULES)} END AS assessment_unit,
 assessed_elements AS assessed, total_violations AS violations,
 CAST(CAST(total_violations AS DOUBLE) / nullif(assessed_elements, 0) * 100 AS DECIMAL(18,4)) AS violation_rate FROM summary"""
ORACLES["report_relational_totals"] = RELATIONAL + f""", summary AS ({RELATIONAL_SUMMARY})
SELECT count(*) AS n_checks, count(*) FILTER (total_violations > 0) AS checks_with_violations,
 sum(total_violations) AS total_violations FROM summary"""
ORACLES["report_patient_histogram"] = p.COMPLETENESS + f""", per_patient AS (
 SELECT PID, {p.percent('count(*) FILTER (is_filled)', 'count(source_id)')} AS v FROM present GROUP BY PID),
edges AS (SELECT min(v) AS low, max(v) AS high FROM per_patient),
placed AS (SELECT least(CAST(floor((v - low) / (high - low) * 10) AS BIGINT) + 1, 10) AS bin FROM per_patient, edges)
SELECT b.bin, CAST(low + (high - low) / 10 * (b.bin - 1) AS DECIMAL(18,4)) AS bin_from,
 CAST(low + (high - low) / 10 * b.bin AS DECIMAL(18,4)) AS bin_to,
 (SELECT count(*) FROM placed WHERE placed.bin = b.bin) AS n_patients
FROM (SELECT unnest(range(1, 11)) AS bin) b, edges"""

ORACLES["job_report"] = ORACLES["report_rates"]
ORACLES["job_histogram"] = ORACLES["report_patient_histogram"]

# Profiling.

PARTS = p.with_(p.ELEMENT_LIST)
ONE_PER_URN = "(SELECT * FROM part_dict QUALIFY row_number() OVER (PARTITION BY dataelement_urn ORDER BY row_ord) = 1)"
ONE_PER_FORM = "(SELECT * FROM part_dict QUALIFY row_number() OVER (PARTITION BY form_id ORDER BY row_ord) = 1)"
ORACLES["profile_counts"] = p.with_(p.ELEMENT_LIST, p.long_export()) + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {e} AS value FROM {t}" for m, e, t in (
        ("dictionary_rows", "count(*)", "part_dict"), ("dictionary_source_ids", "count(DISTINCT source_id)", "part_dict"),
        ("dictionary_element_urns", "count(DISTINCT dataelement_urn)", "part_dict"), ("export_rows", "count(*)", "long"),
        ("export_patients", "count(DISTINCT PID)", "long"), ("export_source_ids", "count(DISTINCT source_id)", "long")))


def _types(source):
    return PARTS + f"""SELECT data_type, n AS n_elements, round_even(CAST(n AS DOUBLE) / sum(n) OVER () * 100, 1) AS percentage
FROM (SELECT data_type, count(*) AS n FROM {source} GROUP BY 1)"""


ORACLES["profile_types"] = _types("part_dict")
ORACLES["profile_types_by_urn"] = _types(ONE_PER_URN)
ORACLES["profile_type_formats"] = PARTS + "SELECT DISTINCT data_type, data_format FROM part_dict"
ORACLES["profile_formats"] = PARTS + f"SELECT data_type, data_format, count(*) AS n_elements FROM {ONE_PER_URN} GROUP BY 1, 2"
ORACLES["profile_date_formats"] = PARTS + f"""
SELECT data_type, data_format, count(*) AS n_elements FROM {ONE_PER_URN} WHERE data_type = 'DATE' GROUP BY 1, 2"""
ORACLES["profile_slots"] = PARTS + f"""
SELECT data_type, slots, count(*) AS n_elements FROM (
 SELECT d.data_type, (SELECT max(CASE WHEN p_size % 3 = 0 THEN 'SELECT_ONE_RADIO' END) FROM part
  WHERE concat('urn:reg:dataelement:', p_size, ':1') = d.dataelement_urn) AS slots
 FROM {ONE_PER_URN} d WHERE data_type = 'enumerated') GROUP BY 1, 2"""
ORACLES["profile_repeated_urns"] = PARTS + """
SELECT dataelement_urn, source_id FROM part_dict QUALIFY count(*) OVER (PARTITION BY dataelement_urn) > 1"""
ORACLES["profile_forms"] = PARTS + """
SELECT form_id, Form, form_type, count(DISTINCT source_id) AS n_elements FROM part_dict GROUP BY 1, 2, 3"""
ORACLES["profile_forms_by_type"] = PARTS + f"SELECT form_type, count(*) AS n_forms FROM {ONE_PER_FORM} GROUP BY 1"
EPISODES = """WITH n AS (SELECT o_custkey, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_episodes FROM orders GROUP BY 1) """
ORACLES["profile_episode_distribution"] = EPISODES + "SELECT n_episodes, count(*) AS n_patients FROM n GROUP BY 1"
ORACLES["profile_episode_describe"] = EPISODES + """
SELECT count(*) AS count, CAST(avg(n_episodes) AS DECIMAL(18,4)) AS mean, CAST(stddev_samp(n_episodes) AS DECIMAL(18,4)) AS std,
 CAST(min(n_episodes) AS DOUBLE) AS min, quantile_cont(CAST(n_episodes AS DOUBLE), 0.25) AS q25,
 quantile_cont(CAST(n_episodes AS DOUBLE), 0.5) AS q50, quantile_cont(CAST(n_episodes AS DOUBLE), 0.75) AS q75,
 CAST(max(n_episodes) AS DOUBLE) AS max, CAST(sum(n_episodes) AS BIGINT) AS n_patient_episodes FROM n"""
ORACLES["profile_missing_pid"] = p.with_(p.long_export()) + """
SELECT count(*) FILTER (PID = '7') AS n_missing_patient_ids, count(*) AS n_rows FROM long"""
ORACLES["profile_unknown_ids"] = p.with_(p.long_export(), p.DICTIONARY) + """
SELECT DISTINCT source_id FROM long WHERE source_id NOT IN (SELECT source_id FROM dict)"""
ORACLES["profile_records"] = PARTS + """
SELECT record_urn, record_designation, record_mandatory, record_repeatable FROM part_dict WHERE record_urn IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY record_urn ORDER BY row_ord) = 1"""
ORACLES["profile_record_nulls"] = PARTS + """
SELECT count(*) FILTER (record_urn IS NULL) AS n_without_record, count(record_urn) AS n_with_record,
 count(DISTINCT record_urn) AS n_records FROM part_dict"""
ORACLES["profile_records_per_form"] = PARTS + """
SELECT form_id, Form, form_type, count(DISTINCT record_urn) AS n_records FROM part_dict GROUP BY 1, 2, 3"""
ORACLES["profile_record_usage"] = PARTS + """
SELECT record_urn, record_designation, count(DISTINCT source_id) AS n_elements, count(DISTINCT form_id) AS n_forms
FROM part_dict WHERE record_urn IS NOT NULL GROUP BY 1, 2"""

# Structural metadata.

ORACLES["element_select"] = """
SELECT concat('urn:reg:dataelement:', p_partkey, ':', p_size) AS dataelement_urn, CAST(p_partkey AS VARCHAR) AS dataelement_id,
 CAST(p_size AS VARCHAR) AS dataelement_version FROM part WHERE p_partkey % 11 <> 0"""
ORACLES["element_flatten"] = p.with_(p.ELEMENT_DOCS) + "SELECT * EXCLUDE (p_brand, p_type, p_name) FROM docs"
ORACLES["codebook"] = p.with_(p.ELEMENT_DOCS) + """
SELECT dataelement_id, dataelement_version, dataelement_urn, p_brand AS pv_value, 'en' AS pv_language,
 p_type AS pv_designation, p_name AS pv_definition, slots AS pv_selection FROM docs WHERE datatype = 'enumerated'
UNION ALL SELECT dataelement_id, dataelement_version, dataelement_urn, p_type, NULL, NULL, NULL, slots
FROM docs WHERE datatype = 'enumerated'"""
ORACLES["dictionary_build"] = PARTS + """
SELECT d.*, CASE WHEN CAST(split_part(dataelement_urn, ':', 4) AS INTEGER) % 3 = 0 THEN 'SELECT_ONE_RADIO' END AS slots
FROM part_dict d"""
ORACLES["rule_validation"] = PARTS + f"""
SELECT 'longitudinal_rules' AS rule_table, concat('P_P', source_id) AS rule_id, concat('P', source_id) AS source_id,
 CASE WHEN record_urn IS NOT NULL THEN 'allowed variation is no number' ELSE 'unknown value type' END AS reason
FROM part_dict WHERE record_urn IS NOT NULL OR data_type NOT IN ('INTEGER', 'FLOAT', 'DATE', 'enumerated')
UNION ALL SELECT 'import_rules', concat('C_P', source_id), CASE WHEN data_type = 'DATE' THEN 'X_0' ELSE concat('P', source_id) END,
 CASE WHEN data_type = 'DATE' THEN 'id missing from the dictionary' ELSE 'unsupported form types' END
FROM part_dict WHERE data_type = 'DATE' OR form_type <> 'Longitudinal'
UNION ALL SELECT 'import_rules', 'IMPORT_004', 'X_9_0_99', 'id missing from the dictionary'
UNION ALL SELECT 'calculation_mappings', 'NO_instance', 'TODO', 'id missing from the dictionary'
UNION ALL SELECT 'date_rules', 'notAfterVariable', 'X_1_0_14', 'unsupported form types'"""
