"""What keeps work in proportion to the input: seen in plans, with the same results."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline import job
from plumbline import fixed_values as fixed
from plumbline.functions.text import has_value, strip, strip_plain
from plumbline.operators import calculation, completeness, longitudinal, relational
from plumbline.plans import catalog, driver_registry as registry

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run(spark, name):
    from plumbline.plans.catalog import QUERIES

    return plan(QUERIES[name](spark, FOLDER))


@pytest.fixture
def large(spark):
    """Spark takes no table for small by itself, as it takes none that is derived by joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["date_summary", "date_dob", "date_after_death"])
def test_the_export_is_not_dealt_by_element(large, name):
    assert "SortMergeJoin [source_id" not in run(large, name)


def test_calculations_shuffle_a_case_once_for_all_formulas(large):
    shuffles = [line for line in run(large, "calc_results").splitlines() if "Exchange hashpartitioning" in line]
    assert not any("variable_alias" in line for line in shuffles)


def test_inputs_mapped_twice_or_never_recorded_make_no_case(frame, rows):
    export = frame("PID Episode_Date IX source_id source_value", [
        (1, "d", 1, "S", "3"), (1, "d", 1, "A", "1"), (1, "d", 1, "B", "2"), (1, "d", 1, "B", "2.0"),
        (2, None, 1, "S", "4"), (2, None, 1, "A", "1"), (2, None, 1, "B", "2"),
        (3, "d", 1, "S", "3"), (3, "d", 1, "A", "1"), (3, "d", 1, "B", "2"), (3, "d", 1, "B", "5")])
    instances = frame("calculation_id calculation_type score_label score_source_id", [
        ("sum", "ADD", None, "S"), ("twice", "ADD", None, "S"), ("never", "ADD", None, "S")])
    formulas = frame("calculation_type formula_expression tolerance rounding", [("ADD", "a + b", "0.1", "none")])
    mappings = frame("calculation_id variable_alias variable_source_id", [
        ("sum", "a", "A"), ("sum", "b", "B"), ("twice", "a", "A"), ("twice", "b", "B"), ("twice", "b", "A"),
        ("never", "a", "A"), ("never", "b", "none")])
    got = calculation.results(export, instances, formulas, mappings)
    assert rows(got, "calculation_id", "PID", "expected_value", "status") == [
        ("sum", "1", 3.0, "pass"), ("sum", "2", 3.0, "violation")]


@pytest.mark.parametrize("name", ["completeness_rows", "empty_basic_forms"])
def test_versions_are_not_broadcast_and_become_elements_last(spark, name):
    joins = [line.split("Join ")[1] for line in run(spark, name).splitlines() if "SortMergeJoin " in line]
    assert sum("PID#" in j for j in joins) == 2 and not any("source_id#" in j for j in joins)


def test_more_elements_than_a_word_of_marks(frame, rows):
    ids = [f"E{i}" for i in range(150)]
    expected = frame("PID episode_date form_id form_version form_type source_id", [
        (p, d, "1", "0", t, e) for p, d, t in ((1, None, "basic"), (1, "d", "longitudinal"), (2, None, "basic"))
        for e in [*ids, None]])
    export = frame("PID Episode_Date source_id source_value", [
        (1, "d", "E70", "x"), (1, "c", "E149", "y"), (1, None, "E3", "z"), (1, "d", "E5", " "), (1, "d", "other", "x")])
    found = completeness.completeness_rows(expected, export)
    assert found.count() == 302  # of patient 1, the only one in the export
    assert rows(found.filter("is_filled"), "form_type", "source_id") == sorted([
        ("basic", "E70"), ("basic", "E149"), ("basic", "E3"), ("longitudinal", "E70")], key=str)


def test_instances_are_counted_by_marks(frame, spark):
    """As from a row per element, also with elements that stand in a form twice, more than a word of them, or none."""
    rng = random.Random(4)
    pick = lambda *x: rng.choice([None, *x])
    ids = [f"E{i}" for i in range(70)]
    elements = frame("form_id form_version source_id dataelement_urn mandatory form_label row_ord", [
        (f, v, e, f"urn:{e}:{rng.randint(1, 2)}", pick("true", " True ", "false"), pick("first", "other"), i)
        for f, v in (("1", "1"), ("2", "1"), ("2", "2"), ("3", None)) for i, e in enumerate([*rng.choices(ids, k=60), None, None])])
    core = frame("form_id dataelement_urn", [(f, f"urn:{e}:9") for f in "12" for e in [*ids[::3], None]])
    versions = frame("PID form_id form_version episode_date form_type", [
        (pick("1", "2", "5"), pick("1", "2", "3"), pick("1", "2", "9"), pick("d1", "d2"), pick("basic", "longitudinal", "other"))
        for _ in range(120)])
    export = frame("PID Episode_Date source_id source_value", [
        (pick("1", "2", "3"), pick("d1", "d2"), pick("U", *ids), pick("x", "y", " ")) for _ in range(150)])
    inputs = versions, elements, export, core
    want = completeness.form_instances(completeness._expanded(*completeness._marked_versions(*inputs[:3]), core))
    got = completeness.instances(*inputs)
    assert dict(got.dtypes) == dict(want.dtypes)
    columns = sorted(want.columns)
    listed = lambda df: sorted(map(str, df.select(columns).collect()))
    assert len(listed(want)) > 20 and listed(got) == listed(want)
    sums = want.agg(*[F.sum(c) for c in ("n", "c", "m", "n_filled", "c_filled", "m_filled")]).first()
    assert all(sums) and want.filter("form_has_any_value and not version_has_any_value").count()


@pytest.mark.parametrize("name", ["completeness_per_patient", "empty_longitudinal_forms", "form_presence_summary"])
def test_form_instances_are_dealt_once_and_have_no_row_per_element(large, name):
    lines = run(large, name).splitlines()
    assert sum("Exchange hashpartitioning(form_type" in x and "spark_grouping_id" not in x and "episode_date" in x for x in lines) == 1
    assert not any("Exchange" in x and "form_type" in x and "form_version" in x and "episode_date" in x for x in lines)
    assert any("bit_count" in x for x in lines)


@pytest.mark.parametrize("name", ["long_numeric", "long_enumerated"])
def test_kinds_without_an_order_list_nothing(spark, name):
    assert "ObjectHashAggregate" not in run(spark, name)


@pytest.mark.parametrize("name", ["completeness_rows", "completeness_per_element", "completeness_per_patient",
                                  "form_presence_summary", "empty_longitudinal_forms"])
def test_completeness_reads_the_export_once(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # shuffles to reuse are then seen in the plan
    try:
        assert run(spark, name).count("lineitem.parquet") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_texts_with_odd_beginnings_have_values(frame):
    texts = ["a", "~", "~a", "!", " a", "\t", "\u00a0", "\u2003x", "\u00e4", "", " ", "\x1c", "\x7f", None]
    got = frame("n text", list(enumerate(texts))).select("n", has_value(F.col("text")).alias("v")).collect()
    assert {int(r.n) for r in got if not r.v} == {5, 6, 9, 10, 11, 13}


@pytest.mark.parametrize("name", ["long_date_increasing", "long_summary", "long_observed_values"])
def test_increasing_variables_list_nothing_and_dates_are_read_of_ruled_values(spark, name):
    lines = run(spark, name).splitlines()
    assert not any("ObjectHashAggregate" in line or "collect_list" in line for line in lines)
    # Shapes of dates are tried where rules have joined, not by a filter below.
    assert any("RLIKE" in line for line in lines) and not any("Filter" in line and "RLIKE" in line for line in lines)


def test_marks_give_the_relational_summary_of_expected_elements(frame, rows):
    """Also with more elements than a word of marks, elements that no form has, blank keys and rows without a patient."""
    rng = random.Random(3)
    pick = lambda *x: rng.choice([None, *x])
    ids = [f"E{i}" for i in range(70)]
    elements = frame("form_id form_version source_id", [(f, v, e) for f, v in (("1", "1"), ("2", "1"), ("2", "2"), ("3", None))
                                                        for e in [*rng.sample(ids, 40), " E3 ", None]])
    versions = frame("PID form_id form_version episode_date form_type", [
        (pick("1", "2 ", "5"), pick("1", "2", "3"), pick("1", "2", "9"), pick("", "d1", "d2 "), pick("basic", "longitudinal", "Basic", "other"))
        for _ in range(40)])
    export = frame("PID Episode_Date source_id source_value", [
        (pick("1", " 2", "3"), pick("", "d1", "d2"), pick("U", "V ", *ids), pick("x", "y", " ")) for _ in range(600)])
    known = frame("source_id", [("U",), (" E1",), *[(e,) for e in ids[5:]], (None,)])
    expected = versions.join(elements, ["form_id", "form_version"], "left")
    want = rows(relational.summary(export, known, expected, elements))
    assert all(r[3] for r in want) and rows(relational.summary_of_versions(export, known, versions, elements)) == want


def test_relational_summary_deals_no_cells(spark):
    """A row per patient and episode is shuffled: ids of elements are a key only where no form has them."""
    assert "bit_or" in run(spark, "rel_summary")


def test_summaries_of_a_report_are_made_one_after_the_other(spark, monkeypatch):
    """Only those of the families that are sections, each of which has left the disks before the next begins."""
    done = []
    for name in catalog.FAMILIES:
        def make(spark, folder, name=name):
            done.append(name)
            kind = {"import_summary": "rule_id string, assessed_elements bigint, total_violations bigint"}.get(
                name, "rule_type string, rule_id string, assessed_elements bigint, total_violations bigint")
            row = ("temporal_plausibility", name, 2, 1)[-3 if name == "import_summary" else -4:]
            return spark.createDataFrame([row], kind)
        monkeypatch.setitem(catalog.QUERIES, name, make)
    monkeypatch.setattr(catalog, "release", lambda spark: done.append("released"))
    got = {r.section: r.n_checks for r in catalog.report_sections(spark, FOLDER).collect()}
    assert sum(got.values()) == 4
    assert done == [x for name in catalog.SECTION_FAMILIES for x in (name, "released")]


@pytest.mark.parametrize("names, stored", [(("report_rates",), 0), (("calculation_results", "report_rates"), 1)])
def test_the_job_stores_cases_only_for_several_results(spark, names, stored):
    kept = []
    long = registry.long_export(spark, FOLDER)
    tables = catalog._job_tables(spark, FOLDER)
    made = job.results(long, tables, job.expected_of(tables), lambda df: kept.append(df.columns) or df,
                       catalog.DATE_OPTIONS | {"rules": catalog.ALL_DATE_RULES}, names)
    for name in names:
        made[name]()
    assert sum("stored_value" in columns for columns in kept) == stored
    assert not any("outcome" in columns for columns in kept)


def test_numeric_variables_bring_no_texts_where_none_are_counted(spark):
    export = spark.createDataFrame([("1", f"0{d}/01/2024", "W", str(d), d) for d in (1, 2, 3)],
                                   "PID string, Episode_Date string, source_id string, source_value string, row_ord bigint")
    rules = spark.createDataFrame([("R", "W", "w", "float", "50")], "rule_id string, source_id string, variable_label string, "
                                                                 "value_type string, allowed_variation_percent string")
    rows = longitudinal.relevant_rows(export, rules)
    assert longitudinal.segments(rows).count() == 6 and longitudinal.segments(rows, texts=False).count() == 3
    assert longitudinal.violations(export, rules).count() == 1


def test_marks_give_the_units_of_elements(frame, rows):
    """Also with more elements than a word of marks, elements that no form has, blank keys and rows without a patient."""
    rng = random.Random(8)
    pick = lambda *x: rng.choice([None, *x])
    ids = [f"E{i}" for i in range(70)]
    elements = frame("form_id form_version source_id", [(f, v, e) for f, v in (("1", "1"), ("2", "1"), ("2", "2"), ("3", None))
                                                        for e in [*rng.sample(ids, 40), " E3 ", None]])
    versions = frame("PID form_id form_version episode_date form_type", [
        (pick("1", "2 ", "5"), pick("1", "2", "3"), pick("1", "2", "9"), pick("", "d1", "d2 "), pick("basic", "longitudinal", "Basic", "other"))
        for _ in range(30)])
    export = frame("PID Episode_Date source_id source_value", [
        (pick("1", " 2", "3"), pick("", "d1", "d2"), pick("U", "V ", *ids), pick("x", "y", " ")) for _ in range(500)])
    expected = versions.join(elements, ["form_id", "form_version"], "left")
    want = relational.element_units(relational.clean_export(export), relational.clean_expected(expected))
    columns = ("PID", "Episode_Date", "source_id", "violated")
    bad = rows(want.filter("violated"), *columns)
    assert len(bad) > 50 and want.count() > len(bad) + 5
    assert rows(relational.element_units_of_versions(export, versions, elements), *columns) == rows(want, *columns)
    assert rows(relational.element_units_of_versions(export, versions, elements, violated_only=True), *columns) == bad


def test_unexpected_elements_are_told_from_a_row_per_episode(spark):
    lines = run(spark, "rel_element_expected").splitlines()
    assert any("bit_or" in x for x in lines)
    # Ids of elements are a key only where no form has them: none of the cells is dealt by its own.
    assert not any("Exchange" in x and "in_observed" in x and "_date" in x for x in lines)


def test_violating_groups_are_kept_before_their_values_are_listed(spark, frame, rows):
    export = spark.createDataFrame(
        [(p, f"0{d}/01/2024", "W", str(v), i) for i, (p, d, v) in enumerate([("1", 1, 1), ("1", 2, 9), ("2", 1, 1), ("2", 2, 1)])],
        "PID string, Episode_Date string, source_id string, source_value string, row_ord bigint")
    rules = frame("rule_id source_id variable_label value_type allowed_variation_percent", [("R", "W", "w", "float", "50")])
    kept = []
    got = longitudinal.observed_values(export, rules, keep=lambda df: kept.append(rows(df)) or df)
    assert kept == [[("1", "W", "R")]] and rows(got, "PID", "value") == [("1", "1"), ("1", "9")]


def test_a_query_lists_values_with_the_violating_groups_stored(spark):
    plan_text = run(spark, "long_observed_values")
    assert "Window" not in plan_text and "plumbline-" in plan_text


def test_texts_are_stripped_of_white_space_of_any_kind(frame):
    edges = ["", " ", "\t", " ", " ", "\x1c", "\n "]
    texts = [f"{a}{t}{b}" for t in ("", "a", "~", "~a", "a b", "!", "ä", "aä", "\x7f") for a in edges for b in edges]
    got = {r.n: r.s for r in frame("n text", list(enumerate(texts)) + [(len(texts), None)]).select(
        "n", F.array(strip(F.col("text")), strip_plain(F.col("text"))).alias("s")).collect()}
    white = fixed.WHITE_SPACE
    assert got == {**{str(i): [t.strip(white)] * 2 for i, t in enumerate(texts)}, str(len(texts)): [None, None]}


def test_the_stored_export_is_made_of_rows_dealt_before(spark, tmp_path, monkeypatch):
    """Its rows are not shuffled: order lines are, before each becomes a row per element. Nothing is sorted by bucket."""
    shuffled = plan(registry.long_export(spark, FOLDER, 4))
    assert shuffled.count("Expand") == 3
    for part in shuffled.split("Expand")[1:]:  # below each
        assert "Exchange hashpartitioning(" in part and "REPARTITION_BY_NUM" in part
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    long = catalog._stored_export(spark, FOLDER, f"file://{tmp_path}/long")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    listed = lambda df: sorted(map(str, df.collect()))
    whole = listed(registry.long_export(spark, FOLDER))
    assert listed(long) == whole
    assert len(list((tmp_path / "long").glob("part-*"))) <= 3 * 4
    counts = long.groupBy("PID").agg(F.count("*").alias("n"))
    assert "Exchange" not in plan(counts)
    assert listed(counts) == listed(registry.long_export(spark, FOLDER).groupBy("PID").agg(F.count("*").alias("n")))
    # A patient with very many rows: buckets go by element too, which rows dealt by patient alone do not.
    monkeypatch.setattr(catalog.clustered, "bucket_keys", lambda rows, buckets: catalog.clustered.CELL)
    assert listed(catalog._stored_export(spark, FOLDER, f"file://{tmp_path}/cells")) == whole


def test_reports_derive_the_export_once_and_drop_it(spark, monkeypatch):
    seen = []

    def make(spark, folder):
        read = registry.long_export(spark, folder)
        seen.append((plan(read), read.inputFiles()))
        return spark.createDataFrame([("temporal_plausibility", "r", 2, 1)], "rule_type string, rule_id string, "
                                     "assessed_elements bigint, total_violations bigint")
    for name in catalog.FAMILIES:
        monkeypatch.setitem(catalog.QUERIES, name, make)
    catalog.report_rates(spark, FOLDER).collect()
    assert len(seen) == 7 and not any("lineitem.parquet" in text for text, _ in seen)
    assert len({tuple(sorted(files)) for _, files in seen}) == 1
    assert "lineitem.parquet" in plan(registry.long_export(spark, FOLDER))
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(seen[0][1][0])
    assert not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def test_the_job_drops_its_stored_export(spark, monkeypatch):
    stored_at = []
    write = catalog.clustered.write_clustered
    monkeypatch.setattr(catalog.clustered, "write_clustered", lambda long, path, *a, **k: stored_at.append(path) or write(long, path, *a, **k))
    monkeypatch.setattr(catalog.job, "assess", lambda *a, **k: [])
    catalog._job(spark, FOLDER, ())
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stored_at[0])
    assert not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
