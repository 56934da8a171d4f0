"""The driver tables as a patient registry.

Customers are patients, orders their episodes and order lines a repeatable record. Values are the tables' own;
some are spoilt by fixed rules on their keys, so that every check meets both good and bad values.
"""

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.plans import registry_rules as rules
from plumbline.sources.local import text_frame

# Expressions below are read by more than one SQL dialect; dialects differ in these three helpers only.
SPARK = {
    "dmy": lambda d: f"date_format({d}, 'dd.MM.yyyy')",
    "slash": lambda d: f"date_format({d}, 'dd/MM/yyyy')",
    "iso": lambda d: f"date_format({d}, 'yyyy-MM-dd')",
    "after": lambda day, n: f"date_add(DATE '{day}', CAST({n} AS INT))",
    "day": lambda t: f"to_date({t})",
}


def money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS STRING)"


def value_expressions(sql: dict) -> dict:
    """Table -> source id -> SQL text of the recorded value."""
    dmy, iso, slash, after, day = (sql[k] for k in ("dmy", "iso", "slash", "after", "day"))
    net = ("ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(4,2)))"
           " * (CAST(1 AS DECIMAL(3,2)) + CAST(l_tax AS DECIMAL(4,2))), 2)")
    return {
        "customer": {
            "X_1_0_11": "CASE WHEN c_custkey % 67 = 0 THEN NULL WHEN c_custkey % 61 = 0 THEN '  '"
                        " WHEN c_custkey % 71 = 0 THEN 'Martian' ELSE c_mktsegment END",
            "X_1_0_12": "CASE WHEN c_custkey % 59 = 0 THEN concat(CAST(c_nationkey AS STRING), '.5')"
                        " ELSE CAST(c_nationkey AS STRING) END",
            "X_1_0_13": f"CASE WHEN c_custkey % 53 = 0 THEN replace({money('c_acctbal')}, '.', ',')"
                        f" WHEN c_custkey % 47 = 0 THEN 'unknown' ELSE {money('c_acctbal')} END",
            "X_1_0_14": f"CASE WHEN c_custkey % 47 = 0 THEN '29.11.0021' WHEN c_custkey % 43 = 0 THEN NULL"
                        f" ELSE {dmy(after('1994-01-01', 'c_custkey * 37 % 1500'))} END",
            "X_1_0_15": f"CASE WHEN c_custkey % 41 = 0 THEN '31.02.2026'"
                        f" ELSE {dmy(after('1996-01-01', 'c_custkey * 53 % 1800'))} END",
            "X_1_0_16": "CAST(c_custkey % 25 AS STRING)",
            "X_1_0_17": f"CASE WHEN c_custkey % 3 = 0 THEN NULL"
                        f" ELSE {dmy(after('1998-06-01', 'c_custkey * 29 % 900'))} END",
        },
        "orders": {
            "X_2_0_21": "o_orderstatus",
            "X_2_0_22": "o_orderpriority",
            "X_2_0_23": f"CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN 'fifty'"
                        f" WHEN o_orderkey % 79 = 0 THEN replace({money('o_totalprice')}, '.', ',')"
                        f" ELSE {money('o_totalprice')} END",
            "X_2_0_24": f"CASE WHEN o_orderkey % 83 = 0 THEN {iso(day('o_orderdate'))}"
                        f" ELSE {dmy(day('o_orderdate'))} END",
            "X_2_0_25": "CASE WHEN o_orderkey % 89 = 0 THEN 'maybe' WHEN o_orderkey % 2 = 0 THEN ' TRUE'"
                        " ELSE 'false' END",
            "X_2_0_26": f"CASE WHEN o_orderkey % 89 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 0.01 AS STRING)"
                        f" ELSE {money('o_totalprice')} END",
            "X_2_0_27": "CAST((o_custkey + CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END) % 25 AS STRING)",
        },
        "lineitem": {
            "X_3_31_41": "CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN '5.5'"
                         " ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
            "X_3_31_42": f"CASE WHEN l_orderkey % 113 = 0 THEN replace({money('l_extendedprice')}, '.', ',')"
                         f" ELSE {money('l_extendedprice')} END",
            "X_3_31_43": money("l_discount"),
            "X_3_31_44": money("l_tax"),
            "X_3_31_45": f"CASE WHEN l_orderkey % 127 = 0 THEN {slash(day('l_shipdate'))}"
                         f" ELSE {iso(day('l_shipdate'))} END",
            "X_3_31_46": "l_returnflag",
            "X_3_31_47": "l_linestatus",
            "X_3_31_48": f"CAST(CASE WHEN l_orderkey % 53 = 0 THEN {net} + 1 ELSE {net} END AS STRING)",
            "X_3_31_49": "CAST(l_suppkey AS STRING)",
        },
    }


KEYS = {
    "customer": ("CAST(c_custkey AS STRING)", "'basic'", "CAST(NULL AS STRING)", "'1'", "c_custkey"),
    "orders": ("CAST(o_custkey AS STRING)", "CAST(o_orderkey AS STRING)", "{slash}", "'1'", "o_orderkey"),
    "lineitem": ("CAST(o_custkey AS STRING)", "CAST(l_orderkey AS STRING)", "{slash}",
                 "CAST(l_linenumber AS STRING)", "l_orderkey * 10 + l_linenumber"),
}
KEY_NAMES = ("PID", "Episode", "Episode_Date", "IX", "row_ord")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: dict[str, DataFrame] = {}


@contextmanager
def stored_export(sf_dir: str, long: DataFrame):
    """While this lasts, ``long`` is what :func:`long_export` reads: the same rows, which several queries need, stored."""
    _STORED[sf_dir] = long
    try:
        yield
    finally:
        del _STORED[sf_dir]


def long_export(spark: SparkSession, sf_dir: str, deal: int | None = None) -> DataFrame:
    """Long export of all values of the three tables. With ``deal`` the tables' rows are dealt by patient into so many
    partitions each, as the export's rows would be, before these are made of them: a row has several times the size then.
    """
    if deal is None and sf_dir in _STORED:
        return _STORED[sf_dir]
    parts = []
    for name, expressions in value_expressions(SPARK).items():
        rows = table(spark, sf_dir, name)
        if name == "lineitem":
            orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
            rows = rows.join(orders, rows["l_orderkey"] == orders["o_orderkey"])
        keys = [k.format(slash=SPARK["slash"]("to_date(o_orderdate)")) for k in KEYS[name]]
        if deal:
            # Neighbours in a file have the patient in common.
            rows = rows.repartition(deal, F.expr(keys[0])).sortWithinPartitions("c_custkey" if name == "customer" else "o_custkey")
        wide = rows.selectExpr(*[f"{k} AS {n}" for k, n in zip(keys, KEY_NAMES)],
                               *[f"{e} AS {i}" for i, e in expressions.items()])
        # Keys are renamed to themselves: with new columns a second use of the export has the same plan, and Spark reuses
        # its shuffles. Columns that are passed through would look different there.
        parts.append(wide.unpivot([F.col(n).alias(n) for n in KEY_NAMES], list(expressions), "source_id", "source_value"))
    return reduce(DataFrame.unionByName, parts).select(
        "PID", "Episode", "Episode_Date", "IX", "source_id", "source_value", "row_ord")


def as_columns(rows: DataFrame, expressions: dict) -> DataFrame:
    """Computed texts as columns that count as given, like those of a file.

    Optimizer rules that reason about null columns would otherwise rewrite every later expression in terms of
    the texts' own expressions, which takes longer than the query.
    """
    fields = ", ".join(f"{e} AS `{c}`" for c, e in expressions.items())
    return rows.selectExpr(f"inline(array(struct({fields})))")


def rule_table(spark: SparkSession, rows, columns) -> DataFrame:
    return text_frame(spark, rows, columns)


def dictionary(spark):
    return rule_table(spark, rules.DICTIONARY, rules.DICTIONARY_COLUMNS)


def codebook(spark):
    return rule_table(spark, rules.CODEBOOK, rules.CODEBOOK_COLUMNS)


def form_elements(spark):
    return rule_table(spark, rules.FORM_ELEMENTS, rules.FORM_ELEMENT_COLUMNS)


def core_elements(spark):
    return rule_table(spark, rules.CORE, rules.CORE_COLUMNS)


def date_rules(spark):
    return rule_table(spark, rules.DATE_RULES, rules.DATE_RULE_COLUMNS)


def longitudinal_rules(spark):
    return rule_table(spark, rules.LONGITUDINAL_RULES, rules.LONGITUDINAL_COLUMNS)


def import_rules(spark):
    return rule_table(spark, rules.IMPORT_RULES, rules.IMPORT_COLUMNS)


def calculation_tables(spark):
    return (
        rule_table(spark, rules.INSTANCES, rules.INSTANCE_COLUMNS),
        rule_table(spark, rules.FORMULAS, rules.FORMULA_COLUMNS),
        rule_table(spark, rules.MAPPINGS, rules.MAPPING_COLUMNS),
    )


def report_texts(spark):
    return rule_table(spark, rules.REPORT_TEXTS, rules.REPORT_COLUMNS)


def basic_versions(spark, sf_dir):
    """Patients of form 1, and of form 4, which nobody has filled in. Some lack form 1; some ids exist only here."""
    customers = table(spark, sf_dir, "customer")
    known = customers.filter("c_custkey % 29 <> 0").selectExpr(
        "CAST(c_custkey AS STRING) AS patient_id", "'1' AS form_id", "CAST(c_custkey % 3 AS STRING) AS version")
    foreign = customers.filter("c_custkey % 31 = 0").selectExpr(
        "concat('Z', CAST(c_custkey AS STRING)) AS patient_id", "'1' AS form_id", "'0' AS version")
    unfilled = customers.filter("c_custkey % 23 = 0").selectExpr(
        "CAST(c_custkey AS STRING) AS patient_id", "'4' AS form_id", "'0' AS version")
    return known.union(foreign).union(unfilled)


def longitudinal_versions(spark, sf_dir):
    """Episodes with forms 2 and 3; some refer to a version that does not exist."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").filter(
        "o_custkey % 29 <> 0")
    slash = SPARK["slash"]("to_date(o_orderdate)")
    return orders.selectExpr(
        "CAST(o_custkey AS STRING) AS patient_id", f"{slash} AS episode_name",
        "inline(array(struct('2' AS form_id, CASE WHEN o_orderkey % 107 = 0 THEN '9'"
        " ELSE CAST(o_orderkey % 3 AS STRING) END AS version), struct('3' AS form_id, '0' AS version)))")


def wide_export(spark, sf_dir):
    """Order lines as rows of a wide export: one basic column, three longitudinal ones, with gaps."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return as_columns(lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]), {
        "PID": "CAST(o_custkey AS STRING)",
        "Episode": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END",
        "Episode_Date": SPARK["slash"]("to_date(o_orderdate)"),
        "row_ord": "l_orderkey * 10 + l_linenumber",
        "X_2_0_22": "CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN ' ' ELSE o_orderpriority END",
        "X_3_31_46": "CASE WHEN l_linenumber = 3 THEN NULL WHEN l_orderkey % 7 = 0 THEN '' ELSE l_returnflag END",
        "X_3_31_41": "CASE WHEN l_linenumber > 4 THEN CAST(CAST(l_quantity AS INT) AS STRING) END",
        "X_3_31_47": "CASE WHEN l_orderkey % 11 = 0 THEN 'nan' ELSE l_linestatus END",
    })


WIDE_BASIC, WIDE_LONGITUDINAL = ("X_2_0_22",), ("X_3_31_46", "X_3_31_41", "X_3_31_47")


def sparse_events(spark, sf_dir):
    """Events as rows of a patient, episode fields given on some event types only."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS PID",
        "CASE WHEN event_type = 'signup' THEN CAST(event_id AS STRING) WHEN event_type = 'click' THEN '' END AS Episode",
        f"CASE WHEN event_type = 'purchase' THEN {SPARK['iso']('to_date(ts)')} END AS Episode_Date",
        "event_id", "ts")


def located_customers(spark, sf_dir):
    """Customers with a location and a marker column, some of them test or empty rows."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS PID",
        "CASE WHEN c_custkey % 17 = 0 THEN concat(' TEST Location ', c_custkey) WHEN c_custkey % 13 = 0 THEN NULL"
        " ELSE concat('Site ', c_nationkey) END AS Location",
        "CASE WHEN c_custkey % 19 = 0 THEN 'No Data ' ELSE concat('U', c_custkey) END"
        " AS `Unique ID (Form_Record_DataElement):`",
        "CASE WHEN c_custkey % 4 = 0 THEN ' ' WHEN c_custkey % 4 = 1 THEN 'nan' WHEN c_custkey % 4 = 2 THEN ''"
        " ELSE c_mktsegment END AS X_1_0_11")


def _brand(column="p_brand"):
    return f"replace({column}, 'Brand#', '')"


def form_documents(spark, sf_dir):
    """One JSON document per part: a form with an element or record item and a text item. Forms of brands above 20 have
    ids that the element list does not know."""
    return table(spark, sf_dir, "part").selectExpr(
        "to_json(map(concat('K', CAST(p_partkey AS STRING)), named_struct("
        f"'id', CAST({_brand()} AS INT) + CASE WHEN CAST({_brand()} AS INT) > 20 THEN 100 ELSE 0 END, 'version', CAST(p_size % 3 AS STRING),"
        " 'label', CASE WHEN p_size % 2 = 0 THEN p_name ELSE '' END, 'name', concat('Form ', p_brand),"
        " 'items', array("
        "named_struct('mdrId', CASE WHEN p_type = 'ECONOMY' THEN concat('urn:reg:record:', CAST(p_size % 10 AS STRING), ':1')"
        " ELSE concat('urn:reg:dataelement:', CAST(p_size AS STRING), ':1') END,"
        " 'label', p_name, 'mandatory', p_size % 2 = 0, 'repeatable', false, 'position', p_partkey),"
        "named_struct('mdrId', 'richtext', 'label', p_name, 'mandatory', false, 'repeatable', false,"
        " 'position', p_partkey + 1))))) AS value")


def element_list(spark, sf_dir):
    """Parts as the raw element list; some rows are empty."""
    columns = {
        "Form": "p_brand",
        "Form ID:Version": f"concat({_brand()}, ':', CAST(p_size % 3 AS STRING))",
        "Form Type": f"CASE WHEN CAST({_brand()} AS INT) % 4 = 0 THEN 'Basic' ELSE 'Longitudinal' END",
        "Record URN": "CASE WHEN p_size % 4 = 0 THEN concat('urn:reg:record:', CAST(p_size % 10 AS STRING), ':1') END",
        "Record Designation": "CASE WHEN p_size % 4 = 0 THEN concat('Record ', CAST(p_size % 10 AS STRING)) END",
        "Record Mandatory": "CASE WHEN p_size % 4 = 0 THEN 'True' END",
        "Record Repeatable": "CASE WHEN p_size % 8 = 0 THEN 'True' END",
        "Data Element - URN": "concat('urn:reg:dataelement:', CAST(p_size AS STRING), ':1')",
        "Data Element - Designation": "p_name",
        "Data Element - Definition": "CAST(NULL AS STRING)",
        "Data Element Mandatory": "CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END",
        "Data Element Repeatable": "'False'",
        "Data Type": "CASE p_size % 6 WHEN 0 THEN 'INTEGER' WHEN 1 THEN 'FLOAT' WHEN 2 THEN 'DATE'"
                     " WHEN 3 THEN 'enumerated' WHEN 4 THEN 'BOOLEAN' END",
        "Data Format": "CASE p_size % 6 WHEN 0 THEN CASE p_size % 24 WHEN 6 THEN concat('1<=X<', CAST(p_size AS STRING))"
                       " WHEN 12 THEN concat(CAST(p_size AS STRING), '<X') WHEN 18 THEN concat('X<=', CAST(p_size AS STRING))"
                       " ELSE concat('X<', CAST(p_size AS STRING)) END WHEN 1 THEN 'X'"
                       " WHEN 2 THEN CASE WHEN p_size % 4 = 0 THEN 'MM.YYYY' ELSE 'DD.MM.YYYY' END"
                       " WHEN 3 THEN 'enumerated' END",
        "Unit of Measure": "CAST(NULL AS STRING)",
    }
    return as_columns(table(spark, sf_dir, "part"), {
        **{c: f"CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE {e} END" for c, e in columns.items()},
        "row_ord": "p_partkey"})


def element_documents(spark, sf_dir):
    """One JSON document per part: an element with designations, slots and permissible values, or without."""
    return table(spark, sf_dir, "part").selectExpr(
        "to_json(named_struct("
        "'identification', named_struct('urn', concat('urn:reg:dataelement:', CAST(p_size AS STRING), ':1'),"
        " 'status', CASE WHEN p_partkey % 5 = 0 THEN 'DRAFT' ELSE 'RELEASED' END),"
        " 'designations', CASE WHEN p_partkey % 7 = 0 THEN array() ELSE array("
        "named_struct('language', 'en', 'designation', p_name, 'definition', p_brand),"
        "named_struct('language', 'de', 'designation', p_brand, 'definition', p_name)) END,"
        " 'validation', named_struct('datatype', CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'enumerated' ELSE 'STRING' END,"
        " 'format', p_type, 'permissible_values', array("
        "named_struct('value', p_brand, 'meanings', array(named_struct('language', 'en', 'designation', p_type,"
        " 'definition', p_name))),"
        "named_struct('value', p_type, 'meanings', CAST(NULL AS array<struct<language: string, designation: string,"
        " definition: string>>)))),"
        " 'slots', CASE WHEN p_size % 3 = 0 THEN array(named_struct('slot_value', 'SELECT_ONE_RADIO')) END)) AS value")


def search_documents(spark, sf_dir):
    """One JSON search result per part: an element and a record."""
    return table(spark, sf_dir, "part").selectExpr(
        "to_json(named_struct('results', array("
        "named_struct('type', 'DATAELEMENT', 'identification', named_struct('urn',"
        " CASE WHEN p_partkey % 11 <> 0 THEN concat('urn:reg:dataelement:', CAST(p_partkey AS STRING), ':',"
        " CAST(p_size AS STRING)) END)),"
        "named_struct('type', 'RECORD', 'identification', named_struct('urn', 'urn:reg:record:1:1'))))) AS value")
