"""Rule tables for the registry that the driver tables form.

Three forms: 1 (basic, customers), 2 (longitudinal, orders) and 3 (longitudinal, order lines, one repeatable
record). Rule tables are data: the checks join them with the tables, whatever their size.
"""

AS_OF = "2000-01-01"
BIRTH_ID, DEATH_ID = "X_1_0_14", "X_1_0_17"
URN = "urn:reg:dataelement:{}:1"
RECORD_URN = "urn:reg:record:{}:1"

# element number: (form, record, label, type, format, record repeatable, slots)
ELEMENTS = {
    11: (1, 0, "Segment", "enumerated", "enumerated", None, None),
    12: (1, 0, "Nation", "INTEGER", "X", None, None),
    13: (1, 0, "Balance", "FLOAT", "0 <= x < 9000", None, None),
    14: (1, 0, "Birth", "DATE", "DD.MM.YYYY", None, None),
    15: (1, 0, "Consent", "DATE", "DD.MM.YYYY", None, None),
    16: (1, 0, "Site", "INTEGER", "X<=20", None, None),
    17: (1, 0, "Last contact", "DATE", "DD.MM.YYYY", None, None),
    21: (2, 0, "Status", "enumerated", "enumerated", None, "SELECT_ONE_RADIO"),
    22: (2, 0, "Priority", "enumerated", "enumerated", None, "SELECT_MANY"),
    23: (2, 0, "Total", " float ", "100<X", None, None),
    24: (2, 0, "Visit", "DATE", "DD.MM.YYYY", None, None),
    25: (2, 0, "Consented", "BOOLEAN", None, None, None),
    26: (2, 0, "Total copy", "FLOAT", "X>0", None, None),
    27: (2, 0, "Site copy", "INTEGER", "X", None, None),
    41: (3, 31, "Quantity", "INTEGER", "1<=X<=45", None, None),
    42: (3, 31, "Price", "FLOAT", "X<=50000", None, None),
    43: (3, 31, "Discount", "FLOAT", "0<=X<0.1", None, None),
    44: (3, 31, "Tax", "FLOAT", "X", None, None),
    45: (3, 31, "Shipped", "DATE", "YYYY-MM-DD", None, None),
    46: (3, 31, "Return flag", "Enumerated", "enumerated", None, None),
    47: (3, 31, "Line status", "enumerated", "enumerated", "True", None),
    48: (3, 31, "Net", "FLOAT", "0<X", None, None),
}


def source_id(element: int) -> str:
    form, record = ELEMENTS[element][:2]
    return f"X_{form}_{record}_{element}"


DICTIONARY_COLUMNS = (
    "Form", "form_id", "form_type", "record_urn", "record_designation", "record_mandatory", "record_repeatable",
    "dataelement_urn", "dataelement_designation", "dataelement_definition", "dataelement_mandatory",
    "dataelement_repeatable", "data_type", "data_format", "unit", "source_id", "slots",
)
DICTIONARY = [
    (f"Form {form}", f"{form}:1", "Basic" if form == 1 else "Longitudinal",
     RECORD_URN.format(record) if record else None, f"Record {record}" if record else None, None, repeatable,
     URN.format(e), label, None, "True" if e % 2 else "False", "False", kind, shape, None, source_id(e), slots)
    for e, (form, record, label, kind, shape, repeatable, slots) in ELEMENTS.items()
]

CODEBOOK_COLUMNS = ("dataelement_urn", "pv_value")
CODEBOOK = [
    (URN.format(e), value)
    for e, values in {
        11: ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY "),
        21: ("F", "O"),
        22: ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
        46: ("A", "N"),
        47: ("F", "O"),
    }.items() for value in values
]

# A form version leaves out every element whose number plus version is a multiple of five.
FORM_ELEMENT_COLUMNS = (
    "form_key", "form_id", "form_version", "form_label", "type", "record_urn", "dataelement_urn", "source_id",
    "mandatory", "repeatable", "position", "resolution_status",
)
FORM_ELEMENTS = [
    (f"{form}_{version}", str(form), str(version), f"Form {form}", "record" if record else "dataelement",
     RECORD_URN.format(record) if record else None, URN.format(e), source_id(e),
     "True" if e % 2 else "False", "False", str(e), "record_resolved" if record else "direct_resolved")
    for version in (0, 1, 2)
    for e, (form, record, *_) in ELEMENTS.items()
    if (e + version) % 5 and (form < 3 or version == 0)
] + [("1_0", "1", "0", "Form 1", "dataelement", None, URN.format(19), "X_1_0_19", "yes", "False", "19",
      "direct_resolved")] + [
    ("4_0", "4", "0", "Form 4", "dataelement", None, URN.format(e), f"X_4_0_{e}", "True", "False", str(e),
     "direct_resolved") for e in (51, 52)]

CORE_COLUMNS = ("form_id", "dataelement_urn")
CORE = [(str(ELEMENTS[e][0]), f"urn:reg:dataelement:{e}:7") for e in (11, 13, 21, 24, 41, 46)]

DATE_RULE_COLUMNS = (
    "Form", "form_type", "record_designation", "dataelement_designation", "source_id", "data_format",
    "notBeforeDOB", "notFuture", "notAfterEpisode", "notBeforeVariable", "notBeforeVariable_source_id",
    "notAfterVariable", "notAfterVariable_source_id", "notAfterDeath",
)
DATE_RULES = [
    (f"Form {ELEMENTS[e][0]}", "Basic" if ELEMENTS[e][0] == 1 else "Longitudinal", None, ELEMENTS[e][2],
     source_id(e), ELEMENTS[e][4], *flags)
    for e, flags in {
        14: ("True", "True", "False", "True", "X_1_0_15", "True", "X_2_0_24", "False"),
        15: ("True", "True", "False", "False", None, "False", None, "False"),
        17: ("True", "TRUE ", "False", "True", "X_1_0_15", "False", None, "False"),
        24: ("True", "true", "True", "True", "X_1_0_15", "True", "X_3_31_45", "False"),
        45: ("True", "True", "True", "True", "X_2_0_24", "False", None, "True"),
    }.items()
]

LONGITUDINAL_COLUMNS = ("rule_id", "source_id", "variable_label", "value_type", "allowed_variation_percent")
LONGITUDINAL_RULES = [
    ("LONG_001", "X_2_0_21", "Status", "enumerated", "0"),
    ("LONG_002", "X_2_0_23", "Total", "float", "5000"),
    ("LONG_003", "X_3_31_41", "Quantity", "integer", "4000"),
    ("LONG_004", "X_3_31_45", "Shipped", "date_increasing", "3"),
    ("LONG_005", "X_2_0_22", "Priority", "radio", "3"),
    ("LONG_006", "X_9_0_99", "Never recorded", "date", "0"),
    ("LONG_007", "X_2_0_25", "Consented", "Multiple-choice", "1"),
]

IMPORT_COLUMNS = ("rule_id", "target_label", "target_source_id", "source_label", "source_source_id")
IMPORT_RULES = [
    ("IMPORT_001", "Total copy", "X_2_0_26", "Total", "X_2_0_23"),
    ("IMPORT_002", "Site copy", "X_2_0_27", "Site", "X_1_0_16"),
    ("IMPORT_003", "Line status", "X_3_31_47", "Return flag", "X_3_31_46"),
    ("IMPORT_004", "Never recorded", "X_9_0_99", "Total", "X_2_0_23"),
]

FORMULA_COLUMNS = ("calculation_type", "formula_expression", "tolerance", "rounding")
FORMULAS = [
    ("NET", "price * (1 - discount) * (1 + tax)", "0.1", "two_decimals"),
    ("BULK", "10 * ln(max(quantity, 1)) + abs(tax - discount) ** 2", "25", "integer"),
    ("INVERSE", "1 / tax - min(discount, 0.05)", "20", "none"),
]
INSTANCE_COLUMNS = ("calculation_id", "calculation_type", "score_label", "score_source_id", "score_urn")
INSTANCES = [
    ("NET_line", "NET", "Net", "X_3_31_48", URN.format(48)),
    ("BULK_line", "BULK", "Quantity", "X_3_31_41", URN.format(41)),
    ("INVERSE_line", "INVERSE", "Tax", "X_3_31_44", URN.format(44)),
    ("NO_formula", "MISSING", "Net", "X_3_31_48", URN.format(48)),
    ("NO_mapping", "NET", "Net", "X_3_31_48", URN.format(48)),
]
MAPPING_COLUMNS = ("calculation_id", "variable_alias", "variable_label", "variable_source_id", "variable_urn")
MAPPINGS = [
    (calculation, ELEMENTS[e][2].lower(), ELEMENTS[e][2], source_id(e), URN.format(e))
    for calculation, elements in {
        "NET_line": (42, 43, 44), "BULK_line": (41, 43, 44), "INVERSE_line": (43, 44),
    }.items() for e in elements
] + [("NO_instance", "todo", "Unknown", "TODO", None)]

REPORT_COLUMNS = ("rule_type", "rule_id", "assessment_unit", "explanation")
REPORT_TEXTS = [
    ("datatype_conformance", "Integer_conformance", "values of integer type", "recorded values are whole numbers"),
    ("datatype_conformance", "Float_conformance ", "values of float type", "recorded values are numbers"),
    ("numeric_range", "", "values with a range", "recorded values lie in their range"),
    ("temporal_plausibility", None, "dates of ruled variables", "dates keep their rules"),
    ("import_check", "import", "copied values", "copies equal their source"),
    ("calculation_check", "calculation", "stored results", "results can be recomputed"),
    ("longitudinal_plausibility", "", "patients and variables", "variation stays within its limit"),
    ("relational_conformance ", None, "ids", "tables refer to each other correctly"),
]
