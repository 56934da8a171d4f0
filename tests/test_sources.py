import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import forms, reshape
from plumbline.session import cut_lineage
from plumbline.sources import metadata_json, readers, writers


def test_long_export_round_trip(spark, tmp_path, rows):
    path = tmp_path / "long.csv"
    path.write_text('PID;Episode;Episode_Date;IX;source_id;source_value\n1;1;d;1;A;"x;y"\n1;1;NA;1;A;\n', encoding="utf8")
    long = readers.read_long_export(spark, str(path))
    assert rows(long, "PID", "Episode_Date", "source_value") == [("1", "d", "x;y"), ("1", None, None)]
    writers.write_csv(long, str(tmp_path / "out"), quote_all=True)
    assert rows(readers.read_table(spark, str(tmp_path / "out")), "source_value") == [("x;y",), (None,)]
    writers.write_long_parquet(long, str(tmp_path / "out.parquet"))
    assert rows(readers.read_long_export(spark, str(tmp_path / "out.parquet")), "source_value") == [("x;y",), (None,)]
    assert cut_lineage(long).count() == 2


def test_wide_export_below_its_preamble(spark, tmp_path, frame, rows):
    lines = [f"about {i}" for i in range(7)] + [
        "PID; Location ;Episode number;Episode date;A;L", "1;Site;1;d1;x;5", ";;;;;", "1;Site;;;x;6", '2;"a;b";1;d1;NaN;7']
    path = tmp_path / "wide.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf8")
    wide = readers.read_wide_export(spark, str(path))
    assert wide.columns == ["PID", "Location", "Episode number", "Episode date", "A", "L", "row_ord"]
    types = frame("source_id form_type", [("A", "basic"), ("L", "longitudinal")])
    got = rows(reshape.build_long(wide, types), "PID", "Episode", "IX", "source_id", "source_value")
    assert got == sorted([("1", "basic", "1", "A", "x"), ("2", "basic", "1", "A", None), ("1", "1", "1", "L", "5"),
                          ("1", "1", "2", "L", "6"), ("2", "1", "1", "L", "7")], key=str)


def test_wide_export_of_several_files(spark, tmp_path, rows):
    for name, cell in (("a", "about 3"), ("b", "y")):
        lines = [f"about {i}" if name == "a" else f"other {i}" for i in range(7)] + ['PID;"B;C"', f"{name};{cell}", "about 3"]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf8")
    wide = readers.read_wide_export(spark, str(tmp_path))
    assert wide.columns == ["PID", "B;C", "row_ord"]
    assert rows(wide.drop("row_ord")) == sorted(
        [("a", "about 3"), ("about 3", None), ("b", "y"), ("about 3", None)], key=str)
    (tmp_path / "c.csv").write_text("\n".join(["x"] * 7 + ["PID;D", "c;1"]) + "\n", encoding="utf8")
    with pytest.raises(ValueError, match="different headers"):
        readers.read_wide_export(spark, str(tmp_path))


def test_element_list_and_rule_table(spark, tmp_path, rows):
    header = ("Form,Form ID:Version,Form Type,Record URN,Record Designation,Record Mandatory,Record Repeatable,"
              "Data Element - URN,Data Element - Designation,Data Element - Definition,Data Element Mandatory,"
              "Data Element Repeatable,Data Type,Data Format,Unit of Measure,Permissible values")
    path = tmp_path / "elements.csv"
    path.write_text("﻿" + header + '\nF,7:1,Basic,,,,,u,label,"two\nlines, ""quoted""",True,False,DATE,X,,more\n', encoding="utf8")
    got = readers.read_element_list(spark, str(path)).collect()
    assert len(got) == 1 and got[0]["Form"] == "F" and got[0]["Data Element - Definition"] == 'two\nlines, "quoted"'
    path = tmp_path / "rules.csv"
    path.write_text("source_id;rule_id;variable_label;value_type;allowed_variation_percent\nA;R;l;float;5\n")
    assert rows(readers.read_rule_table(spark, str(path), "longitudinal_rules")) == [("R", "A", "l", "float", "5")]


def test_form_and_element_documents(spark, tmp_path, rows):
    path = tmp_path / "forms.json"
    path.write_text(json.dumps({"7_1": {"id": 7, "version": 1, "label": "", "name": "N", "items": [
        {"mdrId": "urn:a:dataelement:5:1", "label": "l", "mandatory": True, "repeatable": False, "position": 1},
        {"mdrId": 12}, {"label": "text"}, {"mdrId": "urn:a:record:9:1"}]}, "8_1": {"id": 8, "version": 1}}, indent=1))
    items = forms.form_items(readers_forms := metadata_json.read_forms(spark, str(path)))
    assert readers_forms.count() == 2
    assert rows(items, "form_id", "form_label", "urn", "type", "mandatory") == sorted([
        ("7", "N", "urn:a:dataelement:5:1", "dataelement", "true"), ("7", "N", "urn:a:record:9:1", "record", None)], key=str)
    document = {"identification": {"urn": "urn:a:dataelement:5:2", "status": "RELEASED"}, "designations": [],
                "validation": {"datatype": "enumerated", "format": "enumerated", "permissible_values": [
                    {"value": "y", "meanings": [{"language": "en", "designation": "Yes", "definition": "d"}]}, {"value": 1}]},
                "slots": [{"slot_value": "SELECT_ONE_RADIO"}]}
    docs = spark.createDataFrame([(json.dumps(document),)], "value string")
    elements = metadata_json.parse_elements(docs)
    flat = metadata_json.flatten_elements(elements).first()
    assert (flat.dataelement_id, flat.dataelement_version, flat.language, flat.slots) == ("5", "2", None, "SELECT_ONE_RADIO")
    assert rows(metadata_json.codebook(elements), "pv_value", "pv_designation") == [("1", None), ("y", "Yes")]
    found = spark.createDataFrame([(json.dumps({"results": [
        {"type": "DATAELEMENT", "identification": {"urn": "urn:a:dataelement:5:2"}}, {"type": "RECORD"},
        {"type": "DATAELEMENT", "identification": {}}]}),)], "value string")
    assert rows(metadata_json.select_elements(found)) == [("urn:a:dataelement:5:2", "5", "2")]


def test_ordinal_is_file_order(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a\n" + "\n".join(str(i) for i in range(500)) + "\n")
    table = readers.read_text_table(spark, str(path), ["a"])
    assert [int(r.a) for r in table.orderBy("row_ord").collect()] == list(range(500))
    assert table.select(F.col("row_ord.file")).distinct().count() == 1
