"""Registered queries: every operator on the registry that the driver tables form.

Each takes (spark, folder of the tables) and returns a DataFrame. Every check gets the whole long export; which
elements its rules read is the operator's business.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plumbline.operators import (
    calculation, completeness, dates, dictionary, forms, imports, longitudinal, profile, ranges,
    relational, report, reshape, value,
)
from plumbline import job
from plumbline.plans import driver_registry as registry, registry_rules as rules
from plumbline import session
from plumbline.session import drop_folder, new_folder, release, stored
from plumbline.sources import clustered, metadata_json

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _alone(df: DataFrame) -> DataFrame:
    """Stored at once, and what that shuffled removed before anything else begins."""
    df = stored(df)
    release(df.sparkSession)
    return df


def _stored_export(spark, sf_dir, path):
    """The registry's long export, stored clustered by patient. The tables' rows are shuffled for that where patients alone
    are the buckets, the export's rows otherwise."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = clustered.bucket_keys(registry.long_export(spark, sf_dir), buckets)
    by_patient = keys == clustered.PATIENT
    long = clustered.write_clustered(registry.long_export(spark, sf_dir, buckets if by_patient else None), path, buckets, keys,
                                     dealt=by_patient)
    session.release(spark)
    return long


def _enriched(spark, sf_dir) -> DataFrame:
    return value.enrich(registry.long_export(spark, sf_dir), registry.dictionary(spark))


# Reshaping: wide export to long table.

@query
def long_basic(spark, sf_dir):
    return reshape.basic_long(registry.wide_export(spark, sf_dir), registry.WIDE_BASIC)


@query
def long_longitudinal(spark, sf_dir):
    wide = reshape.empty_to_null(registry.wide_export(spark, sf_dir), registry.WIDE_LONGITUDINAL)
    return reshape.longitudinal_long(wide, registry.WIDE_LONGITUDINAL)


@query
def long_union(spark, sf_dir):
    """E1-E11 from the wide rows; the dictionary decides which columns are basic."""
    ids = registry.WIDE_BASIC + registry.WIDE_LONGITUDINAL
    wide_types = registry.dictionary(spark).filter(F.col("source_id").isin(list(ids))).withColumn(
        "form_type", F.when(F.col("source_id").isin(list(registry.WIDE_BASIC)), "Basic").otherwise(F.col("form_type")))
    return reshape.build_long(registry.wide_export(spark, sf_dir), wide_types)


@query
def ffill_episode_context(spark, sf_dir):
    return reshape.fill_episode_context(
        registry.sparse_events(spark, sf_dir), order=("ts", "event_id"), block=F.date_trunc("hour", "ts"),
    ).select("PID", "event_id", "Episode", "Episode_Date")


@query
def drop_test_and_no_data(spark, sf_dir):
    rows = reshape.drop_no_data_rows(reshape.drop_test_locations(registry.located_customers(spark, sf_dir)))
    return reshape.empty_to_null(rows, ["X_1_0_11"]).select("PID", "Location", "X_1_0_11")


@query
def keep_rows_with_values(spark, sf_dir):
    rows = reshape.keep_rows_with_values(registry.located_customers(spark, sf_dir), ["X_1_0_11"])
    return rows.select("PID", "X_1_0_11")


@query
def value_columns(spark, sf_dir):
    wide, types = reshape.clean_identifiers(registry.wide_export(spark, sf_dir), registry.dictionary(spark))
    counts = wide.agg(F.count("*").alias("n_rows"))
    return reshape.value_columns(wide, types).groupBy("form_type").agg(
        F.count_if("in_export").alias("n_present"), F.count_if(~F.col("in_export")).alias("n_missing"),
    ).withColumn("n_rows", counts.scalar())


# Value conformance and ranges.

@query
def enriched_export(spark, sf_dir):
    return _enriched(spark, sf_dir).groupBy("source_id", "data_type", "data_format", "dataelement_designation").agg(
        F.count("*").alias("n_rows"), F.count("source_value").alias("n_values"))


def _value_query(name, kind):
    def run(spark, sf_dir):
        return value.value_violations(_enriched(spark, sf_dir), registry.codebook(spark), (kind,))
    QUERIES[name] = run


for _name, _kind in (("value_integer", "INTEGER"), ("value_float", "FLOAT"), ("value_boolean", "BOOLEAN"),
                     ("value_date_format", "DATE"), ("value_permissible", "ENUMERATED")):
    _value_query(_name, _kind)


@query
def value_single_choice(spark, sf_dir):
    return value.single_choice_violations(_enriched(spark, sf_dir))


@query
def value_summary(spark, sf_dir):
    return value.summary(registry.long_export(spark, sf_dir), registry.dictionary(spark), registry.codebook(spark))


@query
def value_violations(spark, sf_dir):
    return value.violations(registry.long_export(spark, sf_dir), registry.dictionary(spark), registry.codebook(spark))


@query
def range_parse(spark, sf_dir):
    """R1, R2 on a dictionary as long as the part table's elements."""
    elements = dictionary.add_source_ids(dictionary.rename_columns(registry.element_list(spark, sf_dir)))
    return ranges.parse_ranges(ranges.numeric_rules(elements)).groupBy(
        "data_format", "low", "low_included", "high", "high_included").agg(F.count("*").alias("n_elements"))


@query
def range_violations(spark, sf_dir):
    return ranges.violations(registry.long_export(spark, sf_dir), registry.dictionary(spark)).drop("row_ord")


@query
def range_summary(spark, sf_dir):
    return ranges.summary(registry.long_export(spark, sf_dir), registry.dictionary(spark))


# Temporal plausibility.

DATE_OPTIONS = {"birth_id": rules.BIRTH_ID, "death_id": rules.DEATH_ID, "as_of": rules.AS_OF}
DATE_COLUMNS = ("PID", "Episode", "Episode_Date", "IX", "source_id", "source_value", "data_format",
                "source_value_parsed", "rule_id", "rule_type", "expected", "observed")
ALL_DATE_RULES = (*dates.SIMPLE_RULES, *dates.VARIABLE_RULES)


def _date_query(name, rule_id, *extra):
    def run(spark, sf_dir):
        return dates.violations(registry.long_export(spark, sf_dir), registry.date_rules(spark), rules=(rule_id,),
                                **DATE_OPTIONS).select(*DATE_COLUMNS, *extra)
    QUERIES[name] = run


_date_query("date_dob", "not_before_dob", "dob_parsed")
_date_query("date_after_death", "not_after_death", "death_parsed")
_date_query("date_future", "not_in_future")
_date_query("date_episode", "not_after_episode", "episode_date_parsed")
_date_query("date_before_variable", "not_before_variable", "comparison_source_id", "comparison_date_parsed")
_date_query("date_after_variable", "not_after_variable", "comparison_source_id", "comparison_date_parsed")


@query
def date_summary(spark, sf_dir):
    return dates.summary(registry.long_export(spark, sf_dir), registry.date_rules(spark), rules=ALL_DATE_RULES,
                         **DATE_OPTIONS)


# Forms, expected elements, completeness.

@query
def form_items(spark, sf_dir):
    return forms.form_items(metadata_json.parse_forms(registry.form_documents(spark, sf_dir)))


def _part_dictionary(spark, sf_dir):
    """Dictionary of the part table's elements, form ids with their version."""
    return dictionary.first_per_source_id(dictionary.add_source_ids(dictionary.rename_columns(
        registry.element_list(spark, sf_dir)))).filter("source_id is not null")


def _part_elements(spark, sf_dir):
    return forms.resolve_elements(form_items(spark, sf_dir), _part_dictionary(spark, sf_dir))


@query
def form_elements_resolved(spark, sf_dir):
    return forms.resolved(_part_elements(spark, sf_dir))


@query
def form_elements_unresolved(spark, sf_dir):
    return forms.unresolved(_part_elements(spark, sf_dir))


def _expected(spark, sf_dir):
    return forms.expected_elements(
        registry.basic_versions(spark, sf_dir), registry.longitudinal_versions(spark, sf_dir),
        registry.form_elements(spark))


@query
def expected_elements(spark, sf_dir):
    return _expected(spark, sf_dir).select(
        "PID", "episode_date", "form_id", "form_version", "form_type", "dataelement_urn", "source_id", "mandatory")


@query
def form_versions_present(spark, sf_dir):
    return forms.form_versions_present(_expected(spark, sf_dir))


@query
def expected_summary(spark, sf_dir):
    return forms.expected_summary(form_items(spark, sf_dir), _part_elements(spark, sf_dir), _expected(spark, sf_dir))


def _completeness_inputs(spark, sf_dir):
    versions = forms.expected_versions(
        registry.basic_versions(spark, sf_dir), registry.longitudinal_versions(spark, sf_dir))
    return (versions, registry.form_elements(spark), registry.long_export(spark, sf_dir),
            registry.core_elements(spark))


def _present(spark, sf_dir):
    return completeness.present_forms(completeness.flagged_versions(*_completeness_inputs(spark, sf_dir)))


def _instances(spark, sf_dir):
    return completeness.instances(*_completeness_inputs(spark, sf_dir))


def _present_instances(spark, sf_dir):
    return completeness.present_forms(_instances(spark, sf_dir))


@query
def completeness_rows(spark, sf_dir):
    return _present(spark, sf_dir).select(
        "PID", "episode_date", "form_id", "form_version", "form_type", "source_id", "is_filled", "is_core",
        "form_has_any_value")


@query
def completeness_summary(spark, sf_dir):
    return completeness.completeness_summary(_present_instances(spark, sf_dir))


@query
def form_presence_summary(spark, sf_dir):
    return completeness.form_presence_summary(_instances(spark, sf_dir))


@query
def completeness_per_patient(spark, sf_dir):
    return completeness.completeness_per_patient(_present_instances(spark, sf_dir))


@query
def completeness_per_form(spark, sf_dir):
    return completeness.completeness_per_form(_present_instances(spark, sf_dir))


@query
def completeness_per_form_version(spark, sf_dir):
    return completeness.completeness_per_form_version(_present_instances(spark, sf_dir))


@query
def completeness_per_element(spark, sf_dir):
    return completeness.completeness_per_element(_present(spark, sf_dir))


@query
def empty_basic_forms(spark, sf_dir):
    return completeness.empty_forms(_instances(spark, sf_dir), "basic")


@query
def empty_longitudinal_forms(spark, sf_dir):
    return completeness.empty_forms(_instances(spark, sf_dir), "longitudinal")


# Calculation conformance.

def _calculation_inputs(spark, sf_dir):
    return (registry.long_export(spark, sf_dir), *registry.calculation_tables(spark))


def _printable(case_results):
    """Results with the map as sorted text and doubles at the precision that every engine agrees on."""
    pairs = F.array_sort(F.map_entries("input_values"))
    shown = F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(18,2)").cast("string")))
    return case_results.withColumns({
        "input_values": F.array_join(shown, ";"),
        "stored_value": F.col("stored_value").cast("decimal(18,2)"),
        "expected_value": F.col("expected_value").cast("decimal(18,4)"),
    }).drop("difference")


@query
def calc_results(spark, sf_dir):
    return _printable(calculation.results(*_calculation_inputs(spark, sf_dir)))


@query
def calc_violations(spark, sf_dir):
    return _printable(calculation.violations(calculation.results(*_calculation_inputs(spark, sf_dir))))


@query
def calc_summary(spark, sf_dir):
    inputs = _calculation_inputs(spark, sf_dir)
    return calculation.summary(calculation.results(*inputs), *inputs[1:])


# Import conformance.

def _import_outcomes(spark, sf_dir):
    return imports.outcomes(registry.long_export(spark, sf_dir), registry.import_rules(spark),
                            registry.dictionary(spark))


@query
def import_violations(spark, sf_dir):
    return imports.violations(_import_outcomes(spark, sf_dir))


@query
def import_summary(spark, sf_dir):
    return imports.summary(_import_outcomes(spark, sf_dir), registry.import_rules(spark))


@query
def import_patient_summary(spark, sf_dir):
    return imports.patient_summary(imports.violations(_import_outcomes(spark, sf_dir)))


# Longitudinal plausibility.

def _longitudinal_inputs(spark, sf_dir):
    return registry.long_export(spark, sf_dir), registry.longitudinal_rules(spark)


def _longitudinal_query(name, kind):
    def run(spark, sf_dir):
        rows = longitudinal.violations(*_longitudinal_inputs(spark, sf_dir), kinds=(kind,))
        if kind == "numeric":
            number = lambda c: F.col(c).cast("double").cast("decimal(18,2)").alias(c)
            rows = rows.withColumns({c: number(c) for c in ("min_value", "max_value")})
        return rows.withColumn("observed_variation", F.col("observed_variation").cast("decimal(18,4)"))
    QUERIES[name] = run


_longitudinal_query("long_enumerated", "categorical")
_longitudinal_query("long_date_increasing", "increasing")
_longitudinal_query("long_numeric", "numeric")


@query
def long_summary(spark, sf_dir):
    return longitudinal.summary(*_longitudinal_inputs(spark, sf_dir))


@query
def long_observed_values(spark, sf_dir):
    return longitudinal.observed_values(*_longitudinal_inputs(spark, sf_dir), keep=_alone)


# Relational conformance.

def _relational_sides(spark, sf_dir):
    return (relational.clean_export(registry.long_export(spark, sf_dir)),
            relational.clean_expected(_expected(spark, sf_dir)))


@query
def rel_source_id(spark, sf_dir):
    export, _ = _relational_sides(spark, sf_dir)
    return relational.source_id_violations(relational.source_id_units(export, registry.dictionary(spark)))


@query
def rel_pid_mapping(spark, sf_dir):
    return relational.pid_violations(relational.pid_units(*_relational_sides(spark, sf_dir)))


@query
def rel_element_expected(spark, sf_dir):
    versions, elements, export, _ = _completeness_inputs(spark, sf_dir)
    return relational.element_violations(
        relational.element_units_of_versions(export, versions, elements, violated_only=True))


@query
def rel_form_version(spark, sf_dir):
    _, expected = _relational_sides(spark, sf_dir)
    return relational.form_version_violations(
        relational.form_version_units(expected, registry.form_elements(spark)))


@query
def rel_summary(spark, sf_dir):
    versions, elements, export, _ = _completeness_inputs(spark, sf_dir)
    return relational.summary_of_versions(export, registry.dictionary(spark), versions, elements)


# Report tables.

SECTION_FAMILIES = ("date_summary", "calc_summary", "import_summary", "long_summary")
FAMILIES = ("value_summary", "range_summary", *SECTION_FAMILIES, "rel_summary")


def _summaries(spark, sf_dir, families=FAMILIES):
    """Summaries of the families, made one after the other: each is a row per rule, and its shuffles are removed before
    the next begins, so that the disks hold those of one family at a time. The export that all of them read is derived
    once, stored clustered by patient, and dropped after the last."""
    parts, path = [], new_folder(spark)
    with registry.stored_export(sf_dir, _stored_export(spark, sf_dir, path)):
        for name in families:
            part = QUERIES[name](spark, sf_dir)
            parts.append(stored(imports.contract_summary(part) if name == "import_summary" else part))
            del part
            release(spark)
    drop_folder(spark, path)
    return reduce(DataFrame.unionByName, parts)


@query
def report_rates(spark, sf_dir):
    return report.rule_rates(_summaries(spark, sf_dir), registry.report_texts(spark)).withColumn(
        "violation_rate", F.col("violation_rate").cast("decimal(18,4)"))


@query
def report_sections(spark, sf_dir):
    """Of the families whose rule types are sections of the report; rules of the others are in none."""
    return report.section_totals(_summaries(spark, sf_dir, SECTION_FAMILIES)).withColumn(
        "pooled_violation_rate", F.col("pooled_violation_rate").cast("decimal(18,4)"))


@query
def report_relational(spark, sf_dir):
    return report.relational_checks(rel_summary(spark, sf_dir)).withColumn(
        "violation_rate", F.col("violation_rate").cast("decimal(18,4)"))


@query
def report_relational_totals(spark, sf_dir):
    return report.relational_totals(rel_summary(spark, sf_dir))


@query
def report_patient_histogram(spark, sf_dir):
    edge = lambda c: F.col(c).cast("decimal(18,4)").alias(c)
    return report.patient_histogram(completeness_per_patient(spark, sf_dir)).select(
        "bin", edge("bin_from"), edge("bin_to"), "n_patients")


# The assembled job.

def _job_tables(spark, sf_dir):
    instances, formulas, mappings = registry.calculation_tables(spark)
    return {
        "dictionary": registry.dictionary(spark), "codebook": registry.codebook(spark),
        "form_items": form_items(spark, sf_dir), "form_elements": registry.form_elements(spark),
        "basic_versions": registry.basic_versions(spark, sf_dir),
        "longitudinal_versions": registry.longitudinal_versions(spark, sf_dir),
        "core_elements": registry.core_elements(spark), "date_rules": registry.date_rules(spark),
        "longitudinal_rules": registry.longitudinal_rules(spark), "import_rules": registry.import_rules(spark),
        "calculation_instances": instances, "calculation_formulas": formulas, "calculation_mappings": mappings,
        "report_metadata": registry.report_texts(spark),
    }


def _job(spark, sf_dir, names):
    """Run the job on the registry's long export, which is stored once, and read the results back."""
    out = new_folder(spark)
    long = _stored_export(spark, sf_dir, f"{out}/long_export.parquet")
    written = job.assess(long, _job_tables(spark, sf_dir), out, DATE_OPTIONS | {"rules": ALL_DATE_RULES}, names)
    drop_folder(spark, f"{out}/long_export.parquet")
    return {name: spark.read.parquet(f"{out}/{name}.parquet") for name in written}


@query
def job_report(spark, sf_dir):
    """Rates of all rules, made by the job from one stored long export."""
    return _job(spark, sf_dir, ("report_rates",))["report_rates"].withColumn(
        "violation_rate", F.col("violation_rate").cast("decimal(18,4)"))


@query
def job_histogram(spark, sf_dir):
    edge = lambda c: F.col(c).cast("decimal(18,4)").alias(c)
    return _job(spark, sf_dir, ("report_patient_histogram",))["report_patient_histogram"].select(
        "bin", edge("bin_from"), edge("bin_to"), "n_patients")


# Profiling.

@query
def profile_counts(spark, sf_dir):
    return profile.counts(_part_dictionary(spark, sf_dir), registry.long_export(spark, sf_dir))


@query
def profile_types(spark, sf_dir):
    return profile.type_distribution(_part_dictionary(spark, sf_dir), "source_id")


@query
def profile_types_by_urn(spark, sf_dir):
    return profile.type_distribution(_part_dictionary(spark, sf_dir))


@query
def profile_type_formats(spark, sf_dir):
    return profile.type_formats(_part_dictionary(spark, sf_dir))


@query
def profile_formats(spark, sf_dir):
    return profile.format_distribution(_part_dictionary(spark, sf_dir))


@query
def profile_date_formats(spark, sf_dir):
    return profile.format_distribution(_part_dictionary(spark, sf_dir), "DATE")


@query
def profile_slots(spark, sf_dir):
    return profile.format_distribution(dictionary_build(spark, sf_dir), "enumerated", "slots")


@query
def profile_repeated_urns(spark, sf_dir):
    return profile.repeated_urns(_part_dictionary(spark, sf_dir))


@query
def profile_forms(spark, sf_dir):
    return profile.elements_per_form(_part_dictionary(spark, sf_dir))


@query
def profile_forms_by_type(spark, sf_dir):
    return profile.forms_by_type(_part_dictionary(spark, sf_dir))


@query
def profile_episode_distribution(spark, sf_dir):
    return profile.episode_distribution(registry.long_export(spark, sf_dir))


@query
def profile_episode_describe(spark, sf_dir):
    described = profile.episode_describe(registry.long_export(spark, sf_dir))
    return described.withColumns({c: F.col(c).cast("decimal(18,4)") for c in ("mean", "std")})


@query
def profile_missing_pid(spark, sf_dir):
    export = registry.long_export(spark, sf_dir)
    return profile.missing_pid(export.withColumn("PID", F.nullif("PID", F.lit("7"))))


@query
def profile_unknown_ids(spark, sf_dir):
    return profile.unknown_ids(registry.dictionary(spark), registry.long_export(spark, sf_dir))


@query
def profile_records(spark, sf_dir):
    return profile.records(_part_dictionary(spark, sf_dir))


@query
def profile_record_nulls(spark, sf_dir):
    return profile.record_nulls(_part_dictionary(spark, sf_dir))


@query
def profile_records_per_form(spark, sf_dir):
    return profile.records_per_form(_part_dictionary(spark, sf_dir))


@query
def profile_record_usage(spark, sf_dir):
    return profile.record_usage(_part_dictionary(spark, sf_dir))


# Structural metadata.

def _elements(spark, sf_dir):
    return metadata_json.parse_elements(registry.element_documents(spark, sf_dir))


@query
def element_select(spark, sf_dir):
    return metadata_json.select_elements(registry.search_documents(spark, sf_dir))


@query
def element_flatten(spark, sf_dir):
    return metadata_json.flatten_elements(_elements(spark, sf_dir))


@query
def codebook(spark, sf_dir):
    return metadata_json.codebook(_elements(spark, sf_dir))


@query
def dictionary_build(spark, sf_dir):
    return dictionary.build_dictionary(
        registry.element_list(spark, sf_dir), element_flatten(spark, sf_dir)).filter("source_id is not null")


@query
def rule_validation(spark, sf_dir):
    """S9 with rules taken from the part table's elements next to the registry's own."""
    parts = _part_dictionary(spark, sf_dir).withColumn("source_id", F.concat(F.lit("P"), "source_id"))
    limits = parts.select(
        F.concat(F.lit("P_"), "source_id").alias("rule_id"), "source_id",
        F.col("dataelement_designation").alias("variable_label"),
        F.when(F.col("data_type") == "INTEGER", "integer").otherwise(F.col("data_type")).alias("value_type"),
        F.when(F.col("record_urn").isNull(), "10").otherwise("10%").alias("allowed_variation_percent"))
    copies = parts.select(
        F.concat(F.lit("C_"), "source_id").alias("rule_id"), F.lit(None).cast("string").alias("target_label"),
        F.col("source_id").alias("target_source_id"), F.lit(None).cast("string").alias("source_label"),
        F.when(F.col("data_type") == "DATE", "X_0").otherwise(F.col("source_id")).alias("source_source_id"))
    types = parts.select("source_id", "form_type").unionByName(
        registry.dictionary(spark).select("source_id", "form_type"))
    return dictionary.check_rules(
        types, registry.date_rules(spark), registry.longitudinal_rules(spark).unionByName(limits),
        registry.import_rules(spark).unionByName(copies), registry.calculation_tables(spark)[2])
