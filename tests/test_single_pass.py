"""Checks that read the export once or twice, against plain Python on drawn registries."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.operators import dates, longitudinal, relational, report
from plumbline.plans.catalog import QUERIES
from plumbline.sources import readers

LONG = "PID string, Episode string, Episode_Date string, IX string, source_id string, source_value string, row_ord bigint"
DAYS = [date(2024, 1, 1) + timedelta(days=40 * i) for i in range(6)]


def drawn(seed, n, ids, value):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        day = rng.choice([None, *DAYS])
        out.append((rng.choice(["1", "2", "3", None]), day and str(DAYS.index(day)), day and day.strftime("%d/%m/%Y"), "1",
                    s := rng.choice(ids), value(rng, s), i))
    rng.shuffle(out)
    return out


# Longitudinal plausibility.

LIMITS = [("R1", "W", "w", "float", "50"), ("R2", "D", "d", "date_increasing", "0"), ("R3", "C", "c", "radio", "0")]


def change_value(rng, s):
    return rng.choice({"W": ["0", "1.5", "1.50", "3", "x", " "], "C": ["a", "b ", "b", "", None], "Z": ["1"],
                       "D": [d.strftime("%d.%m.%Y") for d in DAYS[:3]] + ["no date", None]}[s])


def expected_groups(rows):
    groups = defaultdict(list)
    for pid, _, day, _, s, v, at in rows:
        if pid and day and s in "WDC" and v and v.strip():
            groups[pid, s].append((date(*map(int, reversed(day.split("/")))), at, v.strip()))
    out = {}
    for (pid, s), g in groups.items():
        read = {"W": lambda v: float(v) if v != "x" else None, "C": lambda v: v,
                "D": lambda v: date(*map(int, reversed(v.split(".")))) if v[0].isdigit() else None}[s]
        valid = [(d, at, read(v), v) for d, at, v in sorted(g) if read(v) is not None]
        if len({x[0] for x in valid}) < 2:
            continue
        values = [x[2] for x in valid]
        if s == "D":
            varied = float(sum(b < a for a, b in zip(values, values[1:])))
        elif s == "C":
            varied = len({x[3] for x in valid}) - 1.0
        else:
            low, high = min(values), max(values)
            varied = 0.0 if low == high == 0 else float("inf") if low == 0 else (high - low) / abs(low) * 100
        out[pid, s] = (varied, min(x[0] for x in g), max(x[0] for x in g), len({x[0] for x in g}), len(valid),
                       len({x[0] for x in valid}), len(valid) if s == "D" else len({x[3] for x in valid}))
    return out


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_segments_put_together_are_the_sequence(spark, monkeypatch, block):
    monkeypatch.setattr(longitudinal, "block_of", lambda at: F.floor(at / block).cast("bigint"))
    rows = drawn(1, 500, ["W", "D", "C", "Z"], change_value)
    export = spark.createDataFrame(rows, LONG)
    rules = spark.createDataFrame(LIMITS, "rule_id string, source_id string, variable_label string, value_type string, "
                                          "allowed_variation_percent string")
    got = {(r.PID, r.source_id): (r.observed_variation, r.first_episode_date, r.last_episode_date, r.n_episode_dates,
                                  r.n_rows_checked, r.n_valid_dates, r.n_values)
           for r in longitudinal.assessed_groups(export, rules).collect()}
    want = expected_groups(rows)
    assert len(want) == 9 and got == want
    listed = longitudinal.observed_values(export, rules).collect()
    bad = {k for k, v in want.items() if v[0] > (50 if k[1] == "W" else 0)}
    assert {(r.PID, r.source_id) for r in listed} == bad
    for pid, s in bad:
        assert sum((r.PID, r.source_id) == (pid, s) for r in listed) == want[pid, s][6]


# Temporal plausibility.

FLAGS = ("notBeforeDOB", "notAfterDeath", "notFuture", "notAfterEpisode", "notBeforeVariable", "notAfterVariable")
RULES = {  # form type, the four flags, variable not before, variable not after
    "B": ("Basic", "0010", None, None), "V": ("Longitudinal", "1111", "B", "S"), "S": ("Longitudinal", "1001", "V", None),
    "E": ("basic ", "1100", "S", "B"),
}


def date_value(rng, s):
    return rng.choice([d.strftime("%d.%m.%Y") for d in DAYS] + ["01.01.2031", "31.02.2024", None])


def test_one_index_serves_every_comparison(spark):
    rows = drawn(2, 400, list("BVSEZ"), date_value)
    export = spark.createDataFrame(rows, LONG)
    text = lambda b: "True" if b else "False"
    rules = spark.createDataFrame(
        [("f", kind, s, " DD.MM.YYYY", *[text(x == "1") for x in flags], text(before), before, text(after), after, i)
         for i, (s, (kind, flags, before, after)) in enumerate(RULES.items())],
        "Form string, form_type string, source_id string, data_format string, " + ", ".join(
            f"{f} string" for f in FLAGS[:5]) + ", notBeforeVariable_source_id string, notAfterVariable string, "
        "notAfterVariable_source_id string, row_ord bigint")
    day = lambda v: None if v is None or v.startswith("31.02") else date(*map(int, reversed(v.split("."))))
    first = {}
    for pid, episode, _, _, s, v, at in sorted(rows, key=lambda r: r[6]):
        if day(v):
            first.setdefault((s, pid), day(v))
            first.setdefault((s, pid, episode), day(v))
    want = []
    for pid, episode, at_date, _, s, v, at in rows:
        value = day(v)
        if s == "Z" or value is None:
            continue
        kind, flags, before, after = RULES[s]
        shown = at_date and date(*map(int, reversed(at_date.split("/"))))
        birth, death = (first.get((x, pid)) if pid else None for x in "BE")
        asked = [("not_before_dob", flags[0] == "1", birth), ("not_after_death", flags[1] == "1", death),
                 ("not_in_future", flags[2] == "1", date(2030, 1, 1)), ("not_after_episode", flags[3] == "1", shown)]
        for rule, other in (("not_before_variable", before), ("not_after_variable", after)):
            if other:
                basic = RULES[other][0].strip().lower() == "basic"
                if basic or kind == "Longitudinal":
                    asked.append((rule, True, first.get((other, pid) if basic else (other, pid, episode))))
        want += [(at, rule, value < ref if "before" in rule else value > ref) for rule, on, ref in asked if on and ref]
    everything = (*dates.SIMPLE_RULES, *dates.VARIABLE_RULES)
    options = {"birth_id": "B", "death_id": "E", "as_of": "2030-01-01", "rules": everything}
    found = dates.outcomes(export, rules, **options)
    assert sorted((r.row_ord, r.rule_id, r.violated) for r in found.collect()) == sorted(want)
    assert {r for _, r, bad in want if bad} == set(everything)
    only = dates.outcomes(export, rules, as_of="2030-01-01", rules=("not_in_future",))
    assert sorted(r.row_ord for r in only.collect()) == sorted(a for a, r, _ in want if r == "not_in_future")


def test_the_first_of_two_rule_rows_counts(spark, tmp_path):
    path = tmp_path / "dates.csv"
    columns = readers.fixed.RULE_TABLE_COLUMNS["date_rules"]
    path.write_text(";".join(columns) + "\n" + "\n".join(
        f"F;{kind};;n;A;{form};False;False;False;False;;False;" for kind, form in
        (("Longitudinal", "YYYY-MM-DD"), ("Basic", "DD.MM.YYYY"))) + "\n")
    known = dates.known_variables(readers.read_rule_table(spark, str(path), "date_rules")).collect()
    assert [tuple(r) for r in known] == [("A", "longitudinal", "YYYY-MM-DD")]
    path.write_text("rule_type;rule_id;assessment_unit;explanation\nt;R;u;second in the alphabet\nt;R;u;first\n")
    texts = readers.read_rule_table(spark, str(path), "report_metadata")
    summaries = spark.createDataFrame([("t", "R", 2, 1)], "rule_type string, rule_id string, assessed_elements long, "
                                                          "total_violations long")
    assert [r.explanation for r in report.rule_rates(summaries, texts).collect()] == ["second in the alphabet"]


# Relational conformance.

def test_one_reduction_gives_the_units_of_every_rule(spark):
    rng = random.Random(5)
    pick = lambda *x: rng.choice([None, *x])
    export = [(pick("1", "2", "3", " 4"), None, pick("", "d1", "d2"), "1", pick("A", "B ", "C"), pick("x", " "), i)
              for i in range(80)]
    expected = [(pick("1", "2", "5"), pick("d1", "d2 "), pick("A", "B", "C"), pick("1", "2"), pick("1", "9"),
                 pick("Basic", "longitudinal", "other")) for _ in range(60)]
    long = spark.createDataFrame(export, LONG)
    wanted = spark.createDataFrame(expected, "PID string, episode_date string, source_id string, form_id string, "
                                             "form_version string, form_type string")
    known = spark.createDataFrame([("A",), (" B",), (None,)], "source_id string")
    forms = spark.createDataFrame([("1", "1"), ("2", "1 "), (None, "1")], "form_id string, form_version string")
    sides = relational.clean_export(long), relational.clean_expected(wanted)
    alone = (
        relational.source_id_violations(relational.source_id_units(sides[0], known))
        .unionByName(relational.pid_violations(relational.pid_units(*sides)))
        .unionByName(relational.element_violations(relational.element_units(*sides)))
        .unionByName(relational.form_version_violations(relational.form_version_units(sides[1], forms))))
    units = relational.units(long, known, wanted, forms)
    together = relational.violations_of(units)
    assert sorted(map(str, together.collect())) == sorted(map(str, alone.collect()))
    assert len({r.rule_id for r in together.collect()}) == 4
    parts = {relational.SOURCE_ID: relational.source_id_units(sides[0], known), relational.PID_MAPPING: relational.pid_units(*sides),
             relational.ELEMENT: relational.element_units(*sides),
             relational.FORM_VERSION: relational.form_version_units(sides[1], forms)}
    want = {r: (u.count(), u.filter("violated").count()) for r, u in parts.items()}
    assert {r.rule_id: (r.assessed_elements, r.total_violations) for r in relational.summary_of(units).collect()} == want


@pytest.mark.parametrize("name, table, most", [
    ("long_summary", "lineitem", 1), ("long_observed_values", "lineitem", 2), ("date_summary", "lineitem", 2),
    ("rel_summary", "lineitem", 1), ("rel_summary", "orders", 3),
])
def test_how_often_tables_are_read(spark, name, table, most):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{table}.parquet") <= most
