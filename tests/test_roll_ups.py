"""Roll-ups of form instances against plain Python, and how often plans read their inputs."""

import random
from collections import defaultdict

import pytest

from plumbline.operators import completeness, report

COLUMNS = ("form_type string, PID string, episode_date string, form_id string, form_version string, form_label string, "
           "source_id string, mandatory string, is_filled boolean, is_core boolean")


@pytest.fixture(scope="module")
def drawn():
    rng = random.Random(4)
    out = []
    for _ in range(900):
        kind = rng.choice(["basic", "longitudinal", "longitudinal"])
        form = rng.choice(["1", "2", "3", None])
        out.append((kind, rng.choice("abcdefg"), rng.choice([None, "d1", "d2", "d3"]), form, rng.choice(["1", "2"]),
                    rng.choice([None, "B", "A"]), rng.choice([None, "x", "y", "z"]), rng.choice([None, " TRUE", "no"]),
                    rng.random() < 0.1, rng.random() < 0.5))
    return out


def instance(r):
    return (r[0], r[1], r[2] if r[0] == "longitudinal" else None, r[3])


def has_key(r):
    return r[3] is not None and (r[0] == "basic" or r[2] is not None)


def present_of(rows):
    filled = {instance(r) for r in rows if r[8]}
    return [r for r in rows if has_key(r) and instance(r) in filled]


def levels_of(rows, keys):
    """Counts per group of the given key places, and its patients."""
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in keys)].append(r)
    return {k: (sum(r[6] is not None for r in g), sum(r[8] for r in g), sum(r[6] is not None and r[9] for r in g),
                sum(r[9] and r[8] for r in g), len({r[1] for r in g})) for k, g in groups.items()}


def counts(row):
    return row.general_expected_n, row.general_filled_n, row.core_expected_n, row.core_filled_n


def test_one_roll_up_has_every_level(spark, drawn):
    rows = spark.createDataFrame(drawn, COLUMNS)
    instances = completeness.form_instances(rows)
    present = present_of(drawn)
    rolled = completeness.roll_up(completeness.present_forms(instances)).collect()
    at = lambda level: [r for r in rolled if r.level == level]
    for level, keys, places in (("all", [], []), ("type", ["form_type"], [0]), ("patient", ["PID"], [1]),
                                ("form", ["form_id"], [3]), ("version", ["form_id", "form_version"], [3, 4])):
        want = levels_of(present, places)
        got = {tuple(r[k] for k in keys): r for r in at(level)}
        assert got.keys() == want.keys()
        for k, r in got.items():
            assert counts(r) == want[k][:4]
            if level in ("form", "version"):
                assert (r._of_form if level == "form" else r._of_version) == want[k][4]
    labels = {r.form_id: r._label.text for r in at("form")}
    assert labels == {f: min(r[5] for r in present if r[3] == f and r[5]) for f in labels}


def test_levels_alone_equal_levels_together(spark, drawn):
    flagged = completeness.add_presence_flag(spark.createDataFrame(drawn, COLUMNS))
    present = completeness.present_forms(flagged)
    together = completeness.roll_up(present).cache()
    for table in (completeness.completeness_summary, completeness.completeness_per_patient,
                  completeness.completeness_per_form, completeness.completeness_per_form_version):
        assert sorted(map(str, table(present).collect())) == sorted(map(str, table(together).collect()))


def test_presence_by_row_and_by_instance_agree(spark, drawn):
    rows = spark.createDataFrame(drawn, COLUMNS)
    filled = {instance(r) for r in drawn if r[8]}
    for r in completeness.add_presence_flag(rows).collect():
        assert r.form_has_any_value == ((instance(r) in filled) if has_key(r) else None)
    found = completeness.form_instances(rows).collect()
    assert len(found) == len({(*instance(r), r[4]) for r in drawn})
    empty = [r for r in found if not r.version_has_any_value]
    assert sorted(str(r.PID) for t in ("basic", "longitudinal") for r in completeness.empty_forms(rows, t).collect()) == sorted(
        str(r.PID) for r in empty)


def test_roll_ups_of_nothing(spark):
    rows = spark.createDataFrame([], COLUMNS)
    assert completeness.completeness_per_form(rows.withColumn("form_has_any_value", rows.is_filled)).count() == 0
    assert {tuple(r)[1:] for r in completeness.completeness_summary(rows).collect()} == {(None, None, None)}


def scans(df, name):
    return df._jdf.queryExecution().executedPlan().toString().count(f"{name}.parquet")


@pytest.mark.parametrize("name", ["completeness_rows", "completeness_summary", "form_presence_summary",
                                  "completeness_per_patient", "completeness_per_form", "empty_basic_forms",
                                  "report_patient_histogram"])
def test_the_long_export_is_read_twice_at_most(spark, name):
    from plumbline.plans.catalog import QUERIES

    assert scans(QUERIES[name](spark, "/root/testdata/sf0.001"), "lineitem") <= 2


def test_histogram_is_counted_from_percentages(spark):
    values = [0.0, 33.33, 33.33, 66.67, 100.0, 12.5, None]
    patients = spark.createDataFrame([(v,) for v in values], "general_completeness_percent double")
    got = report.patient_histogram(patients, 4).orderBy("bin").collect()
    assert [(r.bin, r.bin_from, r.bin_to, r.n_patients) for r in got] == [
        (1, 0.0, 25.0, 2), (2, 25.0, 50.0, 2), (3, 50.0, 75.0, 1), (4, 75.0, 100.0, 1)]
    same = report.patient_histogram(patients.filter("general_completeness_percent = 12.5"), 2).orderBy("bin").collect()
    assert [(r.bin_from, r.bin_to, r.n_patients) for r in same] == [(12.0, 12.5, 0), (12.5, 13.0, 1)]
    none = report.patient_histogram(patients.filter("false"), 2).collect()
    assert sorted((r.bin, r.bin_from, r.n_patients) for r in none) == [(1, None, 0), (2, None, 0)]
