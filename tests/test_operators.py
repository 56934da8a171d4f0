"""Seeded defects: small clean registries with planted errors, one or more tests per operator family."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import (
    calculation, completeness, dates, dictionary, forms, imports, longitudinal, profile, ranges, relational, report,
    reshape, value,
)

LONG = "PID Episode Episode_Date IX source_id source_value row_ord"


def long_rows(*cells):
    return [(p, e, d, ix, s, v, i) for i, (p, e, d, ix, s, v) in enumerate(cells)]


@pytest.fixture(scope="module")
def elements(frame):
    columns = ("source_id dataelement_designation dataelement_urn record_designation record_urn data_type data_format "
               "record_mandatory dataelement_mandatory record_repeatable dataelement_repeatable slots form_type")
    make = lambda s, kind, fmt, slots=None, repeats=None, form="Longitudinal": (
        s, s, f"urn:{s}", None, None, kind, fmt, None, None, repeats, None, slots, form)
    return frame(columns, [
        make("I", "integer ", "0<X<=10"), make("F", "FLOAT", "X"), make("B", "BOOLEAN", None), make("D", "DATE", "DD.MM.YYYY"),
        make("E", "enumerated", None), make("M", "enumerated", None, "SELECT_MANY"), make("R", "enumerated", None, None, "True"),
        make("G", "FLOAT", "X>0"), make("H", "FLOAT", "-1.5 <= x"), make("S", "INTEGER", "X", form="Basic"),
    ])


@pytest.fixture(scope="module")
def export(frame):
    return frame(LONG, long_rows(
        ("1", "1", "01/01/2026", "1", "I", "5"), ("1", "1", "01/01/2026", "1", "I", "5.5"),
        ("1", "1", "01/01/2026", "1", "I", "11"), ("1", "1", "01/01/2026", "1", "I", " "),
        ("1", "1", "01/01/2026", "1", "F", "12,5"), ("1", "1", "01/01/2026", "1", "F", "fifty"),
        ("1", "1", "01/01/2026", "1", "B", "maybe"), ("1", "1", "01/01/2026", "1", "B", "true"),
        ("1", "1", "01/01/2026", "1", "D", "31.02.2026"), ("1", "1", "01/01/2026", "1", "D", "1.2.2026"),
        ("1", None, None, "1", "E", "yes"), ("1", None, None, "1", "E", "no"), ("2", "1", None, "1", "E", "no "),
        ("2", "1", None, "1", "M", "yes"), ("2", "1", None, "2", "M", "other"),
        ("2", "1", None, "1", "R", "yes"), ("2", "1", None, "2", "R", "yes"),
        ("2", "1", None, "1", "G", "-3"), ("2", "1", None, "1", "H", "-1,5"), ("2", "1", None, "1", "H", "-2"),
        ("2", "1", None, "1", "Z", "not in the dictionary"),
    ))


@pytest.fixture(scope="module")
def codes(frame):
    return frame("dataelement_urn pv_value", [(f"urn:{s}", v) for s in "EMR" for v in ("yes ", "no")])


def test_value_rules(export, elements, codes, rows):
    got = rows(value.violations(export, elements, codes), "rule_id", "source_value", "expected", "observed")
    assert [(r, v, o) for r, v, _, o in got] == sorted([
        ("Integer_conformance", "5.5", "5.5"), ("Float_conformance", "fifty", "fifty"),
        ("Boolean_conformance", "maybe", "maybe"), ("Date_format_conformance", "31.02.2026", "31.02.2026"),
        ("Permissible_values_conformance", "other", "other"),
        ("Single_choice_conformance", "no", "2"), ("Single_choice_conformance", "yes", "2"),
    ], key=str)
    assert "valid date format = DD.MM.YYYY" in {e for _, _, e, _ in got}


def test_value_summary_units(export, elements, codes, rows):
    got = {r[1]: r[2:] for r in rows(value.summary(export, elements, codes))}
    assert got == {
        "Integer_conformance": (3, 1), "Float_conformance": (5, 1), "Boolean_conformance": (2, 1),
        "Date_format_conformance": (2, 1), "Permissible_values_conformance": (7, 1),
        "Single_choice_conformance": (2, 2),  # groups assessed, rows violating
    }


def test_ranges(export, elements, rows):
    got = rows(ranges.violations(export, elements), "source_id", "source_value", "rule_id")
    assert got == [("H", "-2", "NUMERIC_RANGE_CONFORMANCE"), ("I", "11", "NUMERIC_RANGE_CONFORMANCE")]
    # "X>0" is no range that is read, so G is not assessed.
    assert rows(ranges.summary(export, elements)) == [("numeric_range", "range_conformance", 5, 2)]


def test_dates(frame, rows):
    rules = frame(
        "source_id form_type data_format notBeforeDOB notFuture notAfterEpisode notBeforeVariable "
        "notBeforeVariable_source_id notAfterVariable notAfterVariable_source_id", [
            ("BIRTH", "Basic", "DD.MM.YYYY", "True", "True", "False", "False", None, "True", "VISIT"),
            ("CONSENT", "Basic", "DD.MM.YYYY", "True", "True", "False", "True", "CONSENT", "False", None),
            ("VISIT", "Longitudinal", "YYYY-MM-DD", "True", "true ", "True", "True", "CONSENT", "True", "LAB"),
            ("LAB", "Longitudinal", "MM.YYYY", "False", "False", "False", "False", None, "False", None)])
    export = frame(LONG, long_rows(
        ("1", "basic", None, "1", "BIRTH", "01.01.2000"), ("1", "basic", None, "1", "BIRTH", "01.01.1990"),
        ("1", "basic", None, "1", "CONSENT", "01.06.1999"),
        ("1", "7", "05/01/2020", "1", "VISIT", "2020-01-06"), ("1", "7", "05/01/2020", "1", "LAB", "1.2020"),
        ("1", "8", "05/01/2021", "1", "VISIT", "2030-01-01"), ("1", "8", "05.01.2021", "1", "LAB", "bad"),
        ("2", "7", "05/01/2020", "1", "VISIT", "1998-01-01")))
    options = {"birth_id": "BIRTH", "as_of": "2025-01-01"}
    got = rows(dates.violations(export, rules, **options), "rule_id", "PID", "source_id", "observed")
    assert got == sorted([
        ("not_before_dob", "1", "BIRTH", "1990-01-01"), ("not_before_dob", "1", "CONSENT", "1999-06-01"),
        ("not_in_future", "1", "VISIT", "2030-01-01"),
        ("not_after_episode", "1", "VISIT", "2020-01-06"), ("not_after_episode", "1", "VISIT", "2030-01-01"),
        ("not_after_variable", "1", "VISIT", "2020-01-06"),
    ], key=str)
    summary = {r[1]: r[2:] for r in rows(dates.summary(export, rules, **options))}
    assert summary == {"not_before_dob": (5, 2), "not_in_future": (6, 1), "not_after_episode": (3, 2),
                       "not_before_variable": (3, 0), "not_after_variable": (1, 1)}


def test_calculations(frame, rows):
    formulas = frame("calculation_type formula_expression tolerance rounding", [
        ("BMI", "weight * 10000 / height ** 2", "0.1", "one_decimal"), ("LOG", "ln(weight)", "0", "integer")])
    instances = frame("calculation_id calculation_type score_label score_source_id", [
        ("bmi", "BMI", "BMI", "BMI"), ("log", "LOG", None, "LOG"), ("none", "NOPE", "x", "BMI"), ("bare", "BMI", "x", "BMI")])
    mappings = frame("calculation_id variable_alias variable_source_id", [
        ("bmi", "weight", "W"), ("bmi", "height", "H"), ("log", "weight", "W"), ("other", "a", "TODO")])
    export = frame(LONG, long_rows(
        ("1", "1", None, "1", "BMI", "17,3"), ("1", "1", None, "1", "W", "50"), ("1", "1", None, "1", "H", "170"),
        ("1", "1", None, "1", "H", "170.0"), ("1", "1", None, "1", "BMI", "25"),
        ("2", "1", "d", "1", "BMI", "17"), ("2", "1", "d", "1", "W", "50"), ("2", "1", "d", "1", "W", "51"),
        ("2", "1", "d", "1", "H", "170"), ("3", "1", "d", "1", "BMI", "17"), ("3", "1", "d", "1", "W", "50"),
        ("4", "1", "d", "1", "BMI", "17"), ("4", "1", "d", "1", "W", "50"), ("4", "1", "d", "1", "H", "0"),
        ("5", "1", "d", "1", "LOG", "0"), ("5", "1", "d", "1", "W", "0"), ("6", "1", "d", "2", "LOG", "2"),
        ("6", "1", "d", "2", "W", "10")))
    results = calculation.results(export, instances, formulas, mappings)
    assert rows(results, "PID", "calculation_id", "stored_value", "expected_value", "violation") == [
        ("1", "bmi", 17.3, 17.3, False), ("1", "bmi", 25.0, 17.3, True), ("6", "log", 2.0, 2.0, False)]
    assert rows(calculation.summary(results, instances, formulas, mappings)) == sorted([
        ("calculation_check", "bmi", 2, 1), ("calculation_check", "log", 1, 0),
        ("computational_conformance", "none", 0, 0), ("computational_conformance", "bare", 0, 0)], key=str)


def test_tolerances_and_repeated_formulas(frame, rows):
    instances = frame("calculation_id calculation_type score_label score_source_id", [("c", "T", "t", "S")])
    mappings = frame("calculation_id variable_alias variable_source_id", [("c", "a", "A")])
    export = frame(LONG, long_rows(("1", "1", "d", "1", "S", "9"), ("1", "1", "d", "1", "A", "5")))
    formulas = lambda *more: frame("calculation_type formula_expression tolerance", [("T", "a", *more)])
    assert rows(calculation.results(export, instances, formulas("1"), mappings), "violation") == [(True,)]
    assert rows(calculation.results(export, instances, formulas(None), mappings), "violation") == [(False,)]
    assert rows(calculation.results(export, instances, formulas(" "), mappings), "violation") == [(False,)]
    without = formulas("1").drop("tolerance")
    assert rows(calculation.results(export, instances, without, mappings), "tolerance", "violation") == [(0.01, True)]
    with pytest.raises(Exception, match="invalid tolerance"):
        calculation.results(export, instances, formulas("abc"), mappings).collect()
    twice = frame("calculation_type formula_expression tolerance", [("T", "a", "1"), ("T", "a*2", "1")])
    with pytest.raises(ValueError, match="repeated calculation_type"):
        calculation.results(export, instances, twice, mappings)


def test_imports(frame, elements, rows):
    rules = frame("rule_id target_label target_source_id source_label source_source_id", [
        ("R1", "t", "I", "s", "F"), ("R2", "t", "G", "s", "S"), ("R3", "t", "NEVER", "s", "F")])
    export = frame(LONG, long_rows(
        ("1", "1", "d1", "1", "I", "5"), ("1", "1", "d1", "1", "F", "5,0"), ("1", "2", "d2", "1", "I", "5"),
        ("1", "3", "d3", "1", "I", "6"), ("1", "3", "d3", "1", "F", "7"), ("1", "4", "d4", "1", "I", "6"),
        ("1", "4", "d4", "1", "F", "6"), ("1", "4", "d4", "2", "F", "6.0"), ("1", "5", "d5", "1", "I", "6"),
        ("1", "5", "d5", "2", "I", "7"), ("1", "5", "d5", "1", "F", "6"), ("1", "6", "d6", "1", "I", None),
        ("2", "basic", None, "1", "S", "3"), ("2", "1", None, "1", "G", "nan"), ("2", "1", "d1", "1", "G", "3.0")))
    outcomes = imports.outcomes(export, rules, elements)
    assert rows(imports.violations(outcomes), "PID", "episode_date", "rule_id", "source_value", "target_value") == [
        ("1", "d3", "R1", "7", "6"), ("2", None, "R2", "3", "nan")]
    assert {r[0]: r[5:] for r in rows(imports.summary(outcomes, rules))} == {
        "R1": (2, 1, 1, 1, 1), "R2": (2, 1, 0, 0, 0), "R3": (0, 0, 0, 0, 0)}
    assert rows(imports.patient_summary(imports.violations(outcomes))) == [("1", 1, 1, "R1"), ("2", 1, 1, "R2")]
    wrong = frame("rule_id target_label target_source_id source_label source_source_id", [("R9", "t", "S", "s", "I")])
    with pytest.raises(Exception, match="unsupported form types"):
        imports.outcomes(export, wrong, elements).collect()


def test_longitudinal(frame, rows):
    rules = frame("rule_id source_id variable_label value_type allowed_variation_percent", [
        ("C", "RACE", "Race", "enumerated", "0"), ("N", "W", "Weight", "float", "50"),
        ("D", "SEEN", "Seen", "date_increasing", "0"), ("U", "UNUSED", "x", "date", "0")])
    cell = lambda p, d, s, v: (p, "e", d, "1", s, v)
    export = frame(LONG, long_rows(
        cell("1", "01.01.2026", "RACE", "b "), cell("1", "2026-02-01", "RACE", "a"), cell("2", "01.01.2026", "RACE", "a"),
        cell("2", "01.01.2026", "RACE", "b"), cell("3", "01/01/2026", "RACE", "a"), cell("3", "02/01/2026", "RACE", "a"),
        cell("1", "01.01.2026", "W", "50"), cell("1", "01.02.2026", "W", "80"), cell("1", "01.03.2026", "W", "9,9"),
        cell("2", "01.01.2026", "W", "0"), cell("2", "01.02.2026", "W", "1"), cell("3", "01.01.2026", "W", "50"),
        cell("3", "01.02.2026", "W", "75"), cell("4", "01.01.2026", "W", "50"), cell("4", "bad", "W", "500"),
        cell("1", "01.02.2026", "SEEN", "01.01.2026"), cell("1", "01.01.2026", "SEEN", "05.01.2026"),
        cell("1", "01.03.2026", "SEEN", "06.01.2026"), cell("1", "01.03.2026", "SEEN", "02.01.2026")))
    got = rows(longitudinal.violations(export, rules), "rule_id", "PID", "observed_variation",
               "n_episode_dates", "n_rows_checked")
    assert got == sorted([
        ("C", "1", 1.0, 2, 2), ("N", "1", 60.0, 3, 2), ("N", "2", float("inf"), 2, 2),
        ("D", "1", 2.0, 3, 4)], key=str)
    assert {r[1]: r[2:] for r in rows(longitudinal.summary(export, rules))} == {
        "C": (2, 1), "N": (3, 2), "D": (1, 1), "U": (0, 0)}
    # The values themselves are rows, for every violating group.
    values = longitudinal.observed_values(export, rules)
    assert rows(values, "rule_id", "PID", "value") == sorted([
        ("C", "1", "b"), ("C", "1", "a"), ("N", "1", "50"), ("N", "1", "80"), ("N", "2", "0"), ("N", "2", "1"),
        *(("D", "1", f"2026-01-0{d}") for d in (5, 1, 6, 2))], key=str)
    bad = frame("rule_id source_id variable_label value_type allowed_variation_percent", [("X", "W", "w", "float", "many")])
    with pytest.raises(Exception, match="invalid allowed_variation_percent"):
        longitudinal.violations(export, bad).collect()


@pytest.fixture(scope="module")
def expected(frame):
    return frame("PID episode_date form_id form_version form_type form_label dataelement_urn source_id mandatory", [
        ("1", None, "1", "1", "basic", "One", "u:1:1", "A", "True"), ("1", None, "1", "1", "basic", "One", "u:2:1", "B", "no"),
        ("1", None, "2", "1", "basic", "Two", "u:3:1", "C", "yes"), ("1", "d1", "3", "1", "longitudinal", "Three", "u:4:1", "L", "1"),
        ("1", "d2", "3", "1", "longitudinal", "Three", "u:4:1", "L", "1"), ("1", "d2", "9", "9", "longitudinal", None, None, None, None),
        ("9", None, "1", "1", "basic", "One", "u:1:1", "A", "True")])


@pytest.fixture(scope="module")
def recorded(frame):
    return frame(LONG, long_rows(
        ("1", "basic", None, "1", "A", "x"), ("1", "basic", None, "2", "A", " "), ("1", "basic", None, "1", "C", ""),
        ("1", "1", "d1", "1", "L", "5"), ("1", "1", "d1", "1", "Q", "5"), ("2", "1", "d1", "1", "L", "5")))


def test_completeness(expected, recorded, frame, rows):
    core = frame("form_id dataelement_urn", [("1", "u:1:7"), ("3", "u:4:2")])
    flagged = completeness.flagged_rows(expected, recorded, core)
    present = completeness.present_forms(flagged)
    assert rows(flagged, "form_id", "episode_date", "source_id", "is_filled", "is_core", "form_has_any_value") == sorted([
        ("1", None, "A", True, True, True), ("1", None, "B", False, False, True), ("2", None, "C", False, False, False),
        ("3", "d1", "L", True, True, True), ("3", "d2", "L", False, True, False), ("9", "d2", None, False, False, False)], key=str)
    assert {r[0]: r[1:] for r in rows(completeness.completeness_summary(present))} == {
        "Overall element completeness": (66.67, 100.0, 100.0), "Basic form completeness": (50.0, 100.0, 100.0),
        "Longitudinal form completeness": (100.0, 100.0, 100.0)}
    assert {r[0]: r[1:] for r in rows(completeness.form_presence_summary(flagged))} == {
        "Form presence completeness": (5, 2, 40.0), "Empty expected basic forms": (2, 1, 50.0),
        "Empty expected longitudinal forms": (3, 2, 66.67)}
    assert rows(completeness.completeness_per_patient(present)) == [("1", 3, 2, 66.67, 2, 2, 100.0)]
    assert rows(completeness.completeness_per_form(present)) == [
        ("1", "One", 2, 1, 50.0, 1, 1, 100.0, 1), ("3", "Three", 1, 1, 100.0, 1, 1, 100.0, 1)]
    assert len(rows(completeness.completeness_per_form_version(present))) == 2
    assert [r.source_id for r in completeness.completeness_per_element(present).collect()] == ["B", "A", "L"]
    assert rows(completeness.empty_forms(flagged, "basic"), "PID", "form_id", "n_expected_elements") == [("1", "2", 1)]
    assert rows(completeness.empty_forms(flagged, "longitudinal"), "form_id", "n_expected_elements") == [("3", 1), ("9", 0)]


def test_relational(expected, recorded, frame, rows):
    known = frame("source_id", [("A",), ("B",), ("C",), ("L ",)])
    versions = frame("form_id form_version", [("1", "1"), ("2", "1"), ("3", "1 ")])
    got = rows(relational.violations(recorded, known, expected, versions), "rule_id", "PID", "observed")
    assert got == sorted([
        ("Source_id_exists", None, "Q"), ("PID_mapping_conformance", "2", "PID present in export but absent from expected-elements metadata"),
        ("PID_mapping_conformance", "9", "PID present in expected-elements metadata but absent from export"),
        ("Element_expected_for_patient", "1", "1 | d1 | Q"), ("Form_version_exists", None, "9 | version 9")], key=str)
    assert {r[1]: r[2:] for r in rows(relational.summary(recorded, known, expected, versions))} == {
        "Source_id_exists": (4, 1), "PID_mapping_conformance": (3, 2), "Element_expected_for_patient": (3, 1),
        "Form_version_exists": (4, 1)}


def test_reshape(frame, rows):
    wide = frame("PID Location Episode Episode_Date A L row_ord", [
        ("1", "Site", "1", "d1", "x", "5", 1), ("1", "Site", None, "", "x", " ", 2), ("1", "Site", "nan", None, None, "5", 3),
        ("1", "TEST location 3", "2", "d2", "y", "6", 4), ("2", None, None, None, "z", None, 5), ("2", None, "1", "d3", "", "7", 6),
        ("3", None, "1", "d1", None, None, 7)])
    types = frame("source_id form_type", [("A", "Basic "), ("L", " longitudinal"), ("N", "Basic")])
    got = rows(reshape.build_long(wide, types, F.floor(F.col("row_ord") / 2)), "PID", "Episode", "Episode_Date", "IX", "source_id", "source_value")
    assert got == sorted([
        ("1", "basic", None, "1", "A", "x"), ("2", "basic", None, "1", "A", "z"), ("1", "1", "d1", "1", "L", "5"),
        ("1", "1", "d1", "2", "L", "5"), ("2", "1", "d3", "1", "L", "7")], key=str)


def test_forms_and_dictionary(frame, rows):
    columns = "form_id record_urn dataelement_urn data_type row_ord"
    listed = frame(columns, [
        ("7:2", None, "urn:a:dataelement:5:1", "DATE", 1), ("7:3", None, "urn:a:dataelement:5:1", "FLOAT", 2),
        ("7:2", "urn:a:record:9:1", "urn:a:dataelement:6:1", "DATE", 3), (None, None, None, None, 4)])
    built = dictionary.first_per_source_id(dictionary.add_source_ids(listed))
    assert rows(built, "source_id", "data_type") == [("X_7_0_5", "DATE"), ("X_7_9_6", "DATE")]
    items = frame("form_key form_id form_version form_label urn type element_label mandatory repeatable position", [
        ("k", "7", "1", "F", "urn:a:dataelement:5:1", "dataelement", "l", "true", "false", "1"),
        ("k", "7", "1", "F", "urn:a:record:9:1", "record", "l", "true", "false", "2"),
        ("k", "7", "1", "F", "urn:a:record:8:1", "record", "l", "true", "false", "3"),
        ("k", "8", "1", "F", "urn:a:record:9:1", "record", "l", "true", "false", "3")])
    got = forms.resolve_elements(items, built)
    assert rows(got, "source_id", "resolution_status") == sorted([
        ("X_7_0_5", "direct_resolved"), ("X_7_9_6", "record_resolved"), (None, "record_unresolved")], key=str)
    assert rows(profile.type_distribution(built)) == [("DATE", 2, 100.0)]


def test_report(spark, rows):
    summaries = spark.createDataFrame(
        [("temporal_plausibility", "a", 4, 1), ("temporal_plausibility", "b", 0, 0), ("numeric_range", "c", 5, 5)],
        "rule_type string, rule_id string, assessed_elements bigint, total_violations bigint")
    assert rows(report.section_totals(summaries)) == [("temporal_plausibility", 2, 4, 1, 25.0)]
    patients = spark.createDataFrame([(0.0,), (49.0,), (99.0,), (100.0,), (100.0,)], "general_completeness_percent double")
    counts = [r.n_patients for r in report.patient_histogram(patients).orderBy("bin").collect()]
    assert counts == [1, 0, 0, 0, 1, 0, 0, 0, 0, 3]
