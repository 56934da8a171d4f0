"""The clustered long export and the job from files to results."""

import json
import os

import pytest
from pyspark.sql import functions as F

from plumbline import job
from plumbline.operators import completeness, dictionary, imports, longitudinal, relational, value
from plumbline.sources import clustered, readers

LONG = "PID string, Episode string, Episode_Date string, IX string, source_id string, source_value string, row_ord bigint"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def long_rows():
    cells = [(f"p{i % 17}", str(i % 5), f"0{i % 5 + 1}/01/2026", "1", f"X_{i % 7}", str(i % 11), i) for i in range(600)]
    return cells + [(None, "1", None, "1", "X_1", "x", 600), ("p1", "1", None, "1", None, None, 601)]


def test_clustered_rows_group_and_join_by_patient_without_a_shuffle(spark, long_rows, tmp_path):
    path = f"file://{tmp_path}/long.parquet"
    long = spark.createDataFrame(long_rows, LONG)
    assert clustered.bucket_keys(long, 4) == clustered.PATIENT
    table = clustered.write_clustered(long, path, 4)
    assert sorted(map(str, table.collect())) == sorted(map(str, long.collect()))
    assert len([f for f in os.listdir(tmp_path / "long.parquet") if f.startswith("part-")]) <= 4
    again = clustered.open_clustered(spark, path)
    assert again.schema == long.schema
    for keys in (["PID"], ["PID", "source_id"], ["PID", "Episode", "source_id"]):
        counts = again.groupBy(*keys).agg(F.count("*").alias("n"))
        assert "Exchange" not in plan(counts)
        assert sorted(map(str, counts.collect())) == sorted(map(str, long.groupBy(*keys).agg(F.count("*").alias("n")).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        births = again.filter("source_id = 'X_1'").groupBy("PID").agg(F.min("source_value").alias("first"))
        assert "Exchange" not in plan(again.join(births, "PID"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_patient_is_spread_over_elements(spark, long_rows, tmp_path):
    hot = long_rows + [("p1", "1", None, "1", f"X_{i % 40}", "x", 1000 + i) for i in range(1500)]
    long = spark.createDataFrame(hot, LONG)
    assert clustered.bucket_keys(long, 8) == clustered.CELL
    table = clustered.write_clustered(long, f"file://{tmp_path}/long.parquet", 8, clustered.CELL)
    assert table.count() == len(hot)
    assert "Exchange" not in plan(table.groupBy("PID", "source_id", "Episode").count())
    sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < len(hot) / 2
    assert clustered.bucket_keys(long.filter("false"), 8) == clustered.PATIENT


def lines(path, rows):
    path.write_text("\n".join(rows) + "\n", encoding="utf8")


@pytest.fixture
def files(tmp_path):
    """A small registry: two basic elements, three longitudinal ones, three patients, planted defects."""
    at = tmp_path / "in"
    at.mkdir()
    element = lambda form, kind, n, name, type_, format_: (
        f"Form {form},{form}:1,{kind},,,,,urn:r:dataelement:{n}:1,{name},,True,False,{type_},{format_},")
    lines(at / "elements.csv", [",".join(readers.fixed.ELEMENT_LIST_RENAMES),
          element(1, "Basic", 11, "Birth", "DATE", "DD.MM.YYYY"), element(1, "Basic", 12, "Sex", "enumerated", "enumerated"),
          element(2, "Longitudinal", 21, "Weight", "FLOAT", "0<X<300"), element(2, "Longitudinal", 22, "Visit", "DATE", "DD.MM.YYYY"),
          element(2, "Longitudinal", 23, "Weight copy", "FLOAT", "X"), element(2, "Longitudinal", 24, "Double", "FLOAT", "X")])
    document = lambda n, values: json.dumps({
        "identification": {"urn": f"urn:r:dataelement:{n}:1", "status": "RELEASED"}, "designations": [],
        "validation": {"datatype": "enumerated" if values else "STRING", "format": "x",
                       "permissible_values": [{"value": v} for v in values]}, "slots": [{"slot_value": "SELECT_ONE_RADIO"}]})
    lines(at / "elements.jsonl", [document(12, ["f", "m"]), document(21, [])])
    item = lambda n: {"mdrId": f"urn:r:dataelement:{n}:1", "label": str(n), "mandatory": True, "repeatable": False, "position": n}
    (at / "forms.json").write_text(json.dumps({
        "1_1": {"id": 1, "version": 1, "label": "One", "items": [item(11), item(12)]},
        "2_1": {"id": 2, "version": 1, "label": "Two", "items": [item(n) for n in (21, 22, 23, 24)]}}))
    lines(at / "basic_versions.csv", ["patient_id;form_id;version", "1;1;1", "2;1;1", "9;1;1"])
    lines(at / "longitudinal_versions.csv", ["patient_id;episode_name;form_id;version", "1;01/02/2026;2;1", "1;01/03/2026;2;1",
                                             "2;01/02/2026;2;1"])
    lines(at / "core_elements.csv", ["form_id;dataelement_urn", "1;urn:r:dataelement:11:1"])
    lines(at / "date_rules.csv", [";".join(readers.fixed.RULE_TABLE_COLUMNS["date_rules"]),
          "One;Basic;;Birth;X_1_0_11;DD.MM.YYYY;False;True;False;False;;False;",
          "Two;Longitudinal;;Visit;X_2_0_22;DD.MM.YYYY;True;True;True;True;X_1_0_11;False;"])
    lines(at / "longitudinal_rules.csv", ["rule_id;source_id;variable_label;value_type;allowed_variation_percent",
                                          "L1;X_2_0_21;Weight;float;50"])
    lines(at / "import_rules.csv", ["rule_id;target_label;target_source_id;source_label;source_source_id",
                                    "I1;Copy;X_2_0_23;Weight;X_2_0_21"])
    lines(at / "calculation_formulas.csv", ["calculation_type;formula_expression;tolerance;rounding", "D;w * 2;0.1;one_decimal"])
    lines(at / "calculation_instances.csv", ["calculation_id;calculation_type;score_label;score_source_id;score_urn",
                                             "D1;D;Double;X_2_0_24;u"])
    lines(at / "calculation_mappings.csv", ["calculation_id;variable_alias;variable_label;variable_source_id;variable_urn",
                                            "D1;w;Weight;X_2_0_21;u"])
    lines(at / "report_metadata.csv", ["rule_type;rule_id;assessment_unit;explanation", "numeric_range;range_conformance;values;in range"])
    ids = "X_1_0_11;X_1_0_12;X_2_0_21;X_2_0_22;X_2_0_23;X_2_0_24;X_9_0_1"
    lines(at / "export.csv", [f"about {i}" for i in range(7)] + [
        f"PID;Location;Episode number;Episode date;{ids}",
        "1;Site;1;01/02/2026;01.02.1980;f;70;01.02.2026;70;140;",      # all right
        "1;Site;2;01/03/2026;;;150;05.03.2026;151;300;",              # varies, copied wrong, after the episode
        "2;Site;1;01/02/2026;01.02.2030;x;400;01.01.1979;400;1;",     # future, not permissible, out of range, wrong double
        "3;test location;1;01/02/2026;01.02.1980;f;;;;;",              # dropped
        "4;Site;1;01/02/2026;31.02.1980;m;;;;;"])                      # bad date; no expected elements
    return at


def read(spark, out, name):
    return spark.read.parquet(f"{out}/{name}.parquet")


def test_the_job_from_files_to_every_result(spark, files, tmp_path, rows):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    out = f"file://{tmp_path}/out"
    written = job.run(spark, str(files), out, 4, {"birth_id": "X_1_0_11", "as_of": "2026-06-01"}, as_csv=True)
    assert len(written) == len(set(written)) >= 35
    for name in written:
        assert os.path.isdir(tmp_path / "out" / f"{name}.parquet") and os.path.isdir(tmp_path / "out" / name)
    long = clustered.open_clustered(spark, f"{out}/long_export.parquet")
    assert rows(long.filter("PID = '4'"), "source_id", "source_value") == [("X_1_0_11", "31.02.1980"), ("X_1_0_12", "m")] + [
        (f"X_2_0_{n}", None) for n in (21, 22, 23, 24)]
    counts = {r.rule_id: (r.assessed_elements, r.total_violations) for n in written if n.endswith("_summary")
              for r in read(spark, out, n).collect() if "rule_id" in r}
    assert counts["Date_format_conformance"] == (6, 1) and counts["Permissible_values_conformance"] == (3, 1)
    assert counts["range_conformance"] == (3, 1) and counts["L1"] == (1, 1) and counts["I1"] == (3, 1)
    assert counts["not_in_future"] == (5, 1) and counts["not_after_episode"] == (3, 1) and counts["D1"] == (3, 1)
    assert counts["not_before_dob"] == (3, 1) and counts["Source_id_exists"] == (6, 0)
    assert counts["PID_mapping_conformance"] == (4, 2)
    assert rows(read(spark, out, "empty_basic_forms")) == []  # patient 9 is not in the export
    assert {r.rule_id: r.explanation for r in read(spark, out, "report_rates").collect()}["range_conformance"] == "in range"
    assert sum(r.n_patients for r in read(spark, out, "report_patient_histogram").collect()) == 2
    # The results are those of the operators on the frames themselves.
    tables = job.read_tables(spark, str(files))
    expected, plain = job.expected_of(tables), long.select("*")
    pairs = {
        "value_violations": value.violations(plain, tables["dictionary"], tables["codebook"]),
        "longitudinal_violations": longitudinal.violations(plain, tables["longitudinal_rules"]),
        "import_violations": imports.violations(imports.outcomes(plain, tables["import_rules"], tables["dictionary"])),
        "relational_violations": relational.violations(plain, tables["dictionary"], expected, tables["form_elements"]),
        "completeness_per_element": completeness.completeness_per_element(completeness.present_forms(
            completeness.flagged_rows(expected, plain, tables["core_elements"]))),
    }
    for name, df in pairs.items():
        assert rows(read(spark, out, name)) == rows(df), name
    # What was stored for several results is gone.
    left = [f for f in os.listdir(tmp_path / "shared") if f.startswith("plumbline-")] if os.path.isdir(tmp_path / "shared") else []
    assert left == []


def test_the_job_reads_its_stored_export_only(spark, files, tmp_path):
    tables = job.read_tables(spark, str(files))
    from plumbline.operators import reshape

    path = f"file://{tmp_path}/long.parquet"
    long = clustered.write_clustered(reshape.build_long(tables["wide"], tables["dictionary"]), path, 4)
    keep = lambda df: df
    for name, make in job.results(long, tables, job.expected_of(tables), keep, {}).items():
        assert "export.csv" not in plan(make()), name


def test_rule_tables_with_repeated_keys_and_bad_tolerances(frame, rows):
    tables = {
        "date_rules": frame("source_id form_type", [("A", "x"), ("A ", "y"), ("B", "x")]),
        "longitudinal_rules": frame("rule_id source_id", [("R1", "A"), ("R2", "B")]),
        "import_rules": frame("rule_id target_label", [("I", "a"), ("I", "b"), (None, "c"), (None, "d")]),
        "calculation_formulas": frame("calculation_type tolerance", [("D", "0.1"), ("D", None), ("E", "much"), ("F", " ")]),
        "calculation_instances": frame("calculation_id calculation_type", [("D1", "D"), ("D1", "E")]),
        "calculation_mappings": frame("calculation_id variable_alias", [("D1", "w"), ("D1", "h"), ("D1", "w")]),
    }
    assert rows(dictionary.check_tables(tables)) == sorted([
        ("date_rules", None, "A", "repeated key"), ("import_rules", "I", None, "repeated key"),
        ("import_rules", "", None, "repeated key"), ("calculation_formulas", "D", None, "repeated key"),
        ("calculation_formulas", "E", None, "tolerance is no number"),
        ("calculation_instances", "D1", None, "repeated key"), ("calculation_mappings", "D1 | w", None, "repeated key")],
        key=str)
