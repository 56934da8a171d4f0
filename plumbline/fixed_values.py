"""Fixed values.

Rule ids, rule types, result texts, file headers, missing-value tokens and date formats below are part of the
data contract: other tools read them, so they are kept literally and in one place.
"""

# Tokens that mean "missing" in every delimited input.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Names of the raw export's technical columns and what they are called afterwards.
RAW_EXPORT_RENAMES = {
    "Episode number": "Episode",
    "Episode date": "Episode_Date",
    "Episode description": "Episode_Description",
}
UNIQUE_ID_COLUMN = "Unique ID (Form_Record_DataElement):"
RAW_EXPORT_PREAMBLE_LINES = 7
TEST_LOCATION_TEXT = "test location"
NO_DATA_TEXT = "no data"
CELL_MISSING_TOKENS = ("", " ", "nan")
BASIC_EPISODE = "basic"

# Header of the element list and the names used afterwards.
ELEMENT_LIST_RENAMES = {
    "Form": "Form",
    "Form ID:Version": "form_id",
    "Form Type": "form_type",
    "Record URN": "record_urn",
    "Record Designation": "record_designation",
    "Record Mandatory": "record_mandatory",
    "Record Repeatable": "record_repeatable",
    "Data Element - URN": "dataelement_urn",
    "Data Element - Designation": "dataelement_designation",
    "Data Element - Definition": "dataelement_definition",
    "Data Element Mandatory": "dataelement_mandatory",
    "Data Element Repeatable": "dataelement_repeatable",
    "Data Type": "data_type",
    "Data Format": "data_format",
    "Unit of Measure": "unit",
}

# Columns of the rule tables.
RULE_TABLE_COLUMNS = {
    "date_rules": (
        "Form", "form_type", "record_designation", "dataelement_designation", "source_id", "data_format",
        "notBeforeDOB", "notFuture", "notAfterEpisode", "notBeforeVariable", "notBeforeVariable_source_id",
        "notAfterVariable", "notAfterVariable_source_id",
    ),
    "longitudinal_rules": ("rule_id", "source_id", "variable_label", "value_type", "allowed_variation_percent"),
    "import_rules": ("rule_id", "target_label", "target_source_id", "source_label", "source_source_id"),
    "calculation_formulas": ("calculation_type", "formula_expression", "tolerance", "rounding"),
    "calculation_instances": ("calculation_id", "calculation_type", "score_label", "score_source_id", "score_urn"),
    "calculation_mappings": (
        "calculation_id", "variable_alias", "variable_label", "variable_source_id", "variable_urn",
    ),
    "core_elements": ("form_id", "dataelement_urn"),
    "report_metadata": ("rule_type", "rule_id", "assessment_unit", "explanation"),
}

# Columns that tell the rows of a rule table apart.
RULE_TABLE_KEYS = {
    "date_rules": ("source_id",),
    "longitudinal_rules": ("source_id",),
    "import_rules": ("rule_id",),
    "calculation_formulas": ("calculation_type",),
    "calculation_instances": ("calculation_id",),
    "calculation_mappings": ("calculation_id", "variable_alias"),
    "core_elements": ("form_id", "dataelement_urn"),
}

# Value-conformance rules as (logical type, rule_id, rule_type, expected text).
VALUE_RULES = (
    ("INTEGER", "Integer_conformance", "datatype_conformance", "whole number"),
    ("FLOAT", "Float_conformance", "datatype_conformance",
     "numeric value using dot or comma as decimal separator"),
    ("BOOLEAN", "Boolean_conformance", "datatype_conformance", "True or False"),
    ("DATE", "Date_format_conformance", "Date_format_conformance", "valid date format = "),
    ("ENUMERATED", "Permissible_values_conformance", "permissible_values",
     "value exists in permissible values for this dataelement_urn"),
)
SINGLE_CHOICE_RULE = (
    "Single_choice_conformance", "Single_choice_conformance",
    "only one selected value for single-choice enumerated variable",
)
SINGLE_CHOICE_SLOTS = ("", "SELECT_ONE_RADIO")

# Range conformance uses one id in its violations and another in its summary.
RANGE_VIOLATION_RULE = ("NUMERIC_RANGE_CONFORMANCE", "numeric_range",
                        "value falls within metadata-defined numeric range")
RANGE_SUMMARY_RULE = ("range_conformance", "numeric_range")

# Temporal rules as (rule_id, expected text).
TEMPORAL_RULE_TYPE = "temporal_plausibility"
TEMPORAL_RULES = (
    ("not_before_dob", "date is not before DOB"),
    ("not_after_death", "date is not after death"),
    ("not_in_future", "date is not in the future"),
    ("not_after_episode", "date is not after the episode date"),
    ("not_before_variable", "date is not before comparison variable"),
    ("not_after_variable", "date is not after comparison variable"),
)

# Texts that read as "yes" in the mandatory column.
MANDATORY_TEXTS = ("true", "1", "yes")

# Names of the completeness metrics.
COMPLETENESS_METRICS = (
    ("all", "Overall element completeness"),
    ("basic", "Basic form completeness"),
    ("longitudinal", "Longitudinal form completeness"),
)
PRESENCE_METRICS = (
    "Form presence completeness", "Empty expected basic forms", "Empty expected longitudinal forms",
)

# Names of the expected-elements metrics.
EXPECTED_METRICS = (
    "form_versions_found", "form_items_extracted_from_json", "direct_dataelement_items", "record_items",
    "resolved_items", "unresolved_items", "resolved_items_used_for_expected_elements",
    "expected_basic_elements", "expected_longitudinal_elements", "total_expected_elements",
)

# Rule types of calculation summaries, evaluated and skipped.
CALCULATION_RULE_TYPE = "calculation_check"
CALCULATION_SKIPPED_RULE_TYPE = "computational_conformance"
DEFAULT_TOLERANCE = 0.01
ROUNDING_SCALES = {"integer": 0, "nearest_integer": 0, "one_decimal": 1, "two_decimals": 2}

# Marker of an ambiguous value in import checks, and the family's rule type in the report.
MULTIPLE_VALUES = "MULTIPLE_VALUES"
IMPORT_RULE_TYPE = "import_check"

# Value types of longitudinal rules.
LONGITUDINAL_RULE_TYPE = "longitudinal_plausibility"
INCREASING_TYPES = ("date_increasing",)
NUMERIC_TYPES = ("float", "integer", "numeric")
CATEGORICAL_TYPES = ("enumerated", "multiple-choice", "radio", "dropdown", "date")

# Relational rules as (rule_id, expected text, display name, assessment unit).
RELATIONAL_RULE_TYPE = "relational_conformance"
RELATIONAL_RULES = (
    ("Source_id_exists", "source_id exists in the data dictionary",
     "Source ID existence", "Unique source IDs"),
    ("PID_mapping_conformance", "PID is represented in both the export and expected-elements metadata",
     "Patient ID mapping", "Unique patient IDs"),
    ("Element_expected_for_patient",
     "patient-source_id combination exists in expected-elements metadata for the applicable basic or "
     "longitudinal instance",
     "Element expected for patient", "Recorded patient–element instances"),
    ("Form_version_exists",
     "form_id and form_version combination exists in versioned Form Editor metadata",
     "Form-version existence", "Referenced form versions"),
)
PID_ONLY_IN_EXPORT = "PID present in export but absent from expected-elements metadata"
PID_ONLY_IN_EXPECTED = "PID present in expected-elements metadata but absent from export"
