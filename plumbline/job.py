"""The whole assessment: from the exported files to every result table.

The long export is derived once and stored clustered by patient; every check reads that table. What several results
share (form instances, calculation results, import outcomes) is stored once too, in the shared folder, and dropped at the
end; the report is made from the stored summaries. All results are written to one folder, a table each.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from plumbline import fixed_values as fixed
from plumbline.operators import (
    calculation, completeness, dates, dictionary, forms, imports, longitudinal, profile, ranges, relational, report,
    reshape, value,
)
from plumbline.session import drop_folder, new_folder, release, stored
from plumbline.sources import clustered, metadata_json, readers, writers

#: File, below the input folder, of every table the checks read.
FILES = {
    "export": "export.csv", "element_list": "elements.csv", "element_documents": "elements.jsonl", "forms": "forms.json",
    "basic_versions": "basic_versions.csv", "longitudinal_versions": "longitudinal_versions.csv",
    **{name: f"{name}.csv" for name in (
        "core_elements", "date_rules", "longitudinal_rules", "import_rules", "calculation_formulas",
        "calculation_instances", "calculation_mappings", "report_metadata")},
}
RULES = [name for name in FILES if name in fixed.RULE_TABLE_COLUMNS]

#: Rows that several results share, by those results; the reports need them for the stored summaries only.
USES = {
    "cases": {"calculation_results", "calculation_violations", "summary"},
    "copies": {"import_violations", "import_patient_summary", "summary"},
}
SECTION_FAMILIES = ("date_summary", "calculation_summary", "import_summary", "longitudinal_summary")
SUMMED = dict.fromkeys(("calculation_summary", "import_summary", "report_rates", "report_sections"), "summary")


def read_tables(spark: SparkSession, folder: str, files: dict[str, str] = FILES) -> dict[str, DataFrame]:
    """All inputs: ``wide`` (the raw export), the dictionary, the codebook, form elements, versions and rule tables.

    Element documents are read one to a line, form definitions one object to a file.
    """
    at = lambda name: f"{folder}/{files[name]}"
    documents = metadata_json.parse_elements(spark.read.text(at("element_documents")))
    tables = {name: readers.read_rule_table(spark, at(name), name) for name in RULES}
    tables["wide"] = readers.read_wide_export(spark, at("export"))
    tables["dictionary"] = dictionary.build_dictionary(
        readers.read_element_list(spark, at("element_list")), metadata_json.flatten_elements(documents)).filter(
        "source_id is not null")
    tables["codebook"] = metadata_json.codebook(documents)
    tables["form_items"] = forms.form_items(metadata_json.read_forms(spark, at("forms")))
    tables["form_elements"] = forms.resolve_elements(tables["form_items"], tables["dictionary"])
    for name in ("basic_versions", "longitudinal_versions"):
        tables[name] = readers.read_table(spark, at(name))
    return tables


def expected_of(tables: dict[str, DataFrame]) -> DataFrame:
    return forms.expected_elements(
        tables["basic_versions"], tables["longitudinal_versions"], forms.resolved(tables["form_elements"]))


def results(long: DataFrame, tables: dict[str, DataFrame], expected: DataFrame, keep: Callable[[DataFrame], DataFrame],
            dates_by: dict, names=None) -> dict[str, Callable[[], DataFrame]]:
    """Every result by name, as functions; ``keep`` stores what several of them share when it is first asked for. Rows that
    only one of the results asked for (``names``, by default all) needs are not stored."""
    held: dict[str, DataFrame] = {}

    def shared(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if names is not None and len({SUMMED.get(n, n) for n in names} & USES.get(name, set())) == 1:
            return make()
        if name not in held:
            held[name] = keep(make())
        return held[name]

    known, rules = tables["dictionary"], tables
    expected_rows = lambda: shared("expected", lambda: expected)
    calculations = [rules[f"calculation_{n}"] for n in ("instances", "formulas", "mappings")]
    cases = lambda: shared("cases", lambda: calculation.results(long, *calculations))
    copies = lambda: shared("copies", lambda: imports.outcomes(long, rules["import_rules"], known))
    versions = (forms.expected_versions(tables["basic_versions"], tables["longitudinal_versions"]),
                forms.resolved(tables["form_elements"]), long, rules["core_elements"])
    form_sums = lambda: shared("instances", lambda: completeness.instances(*versions))
    rolled = lambda: shared("levels", lambda: completeness.roll_up(completeness.present_forms(form_sums())))
    per_patient = lambda: completeness.completeness_per_patient(rolled())
    related = lambda: shared("units", lambda: relational.units(long, known, expected_rows(), tables["form_elements"]))
    summaries = {
        "value_summary": lambda: value.summary(long, known, tables["codebook"]),
        "range_summary": lambda: ranges.summary(long, known),
        "date_summary": lambda: dates.summary(long, rules["date_rules"], **dates_by),
        "calculation_summary": lambda: calculation.summary(cases(), *calculations),
        "import_summary": lambda: imports.summary(copies(), rules["import_rules"]),
        "longitudinal_summary": lambda: longitudinal.summary(long, rules["longitudinal_rules"]),
        "relational_summary": lambda: relational.summary_of_versions(long, known, versions[0], tables["form_elements"]),
    }

    def all_summaries(families=tuple(summaries)) -> DataFrame:
        parts = {name: shared(name, summaries[name]) for name in families}
        parts["import_summary"] = imports.contract_summary(parts["import_summary"])
        return reduce(DataFrame.unionByName, parts.values())

    relational_counts = lambda: shared("relational_summary", summaries["relational_summary"])

    return {
        "rule_problems": lambda: dictionary.check_rules(
            known, rules["date_rules"], rules["longitudinal_rules"], rules["import_rules"], calculations[2]).unionByName(
            dictionary.check_tables({name: rules[name] for name in RULES})),
        "expected_elements": expected_rows,
        "form_versions_present": lambda: forms.form_versions_present(expected_rows()),
        "expected_summary": lambda: forms.expected_summary(tables["form_items"], tables["form_elements"], expected_rows()),
        "value_violations": lambda: value.violations(long, known, tables["codebook"]),
        "range_violations": lambda: ranges.violations(long, known),
        "date_violations": lambda: dates.violations(long, rules["date_rules"], **dates_by),
        "calculation_results": cases,
        "calculation_violations": lambda: calculation.violations(cases()),
        "import_violations": lambda: imports.violations(copies()),
        "import_patient_summary": lambda: imports.patient_summary(imports.violations(copies())),
        "longitudinal_violations": lambda: longitudinal.violations(long, rules["longitudinal_rules"]),
        "longitudinal_values": lambda: longitudinal.observed_values(long, rules["longitudinal_rules"], keep=keep),
        "relational_violations": lambda: relational.violations_of(related()),
        **{name: lambda name=name, make=make: shared(name, make) for name, make in summaries.items()},
        "completeness_rows": lambda: completeness.present_forms(
            completeness.flagged_versions(*versions)),
        "completeness_summary": lambda: completeness.completeness_summary(rolled()),
        "form_presence_summary": lambda: completeness.form_presence_summary(form_sums()),
        "completeness_per_patient": per_patient,
        "completeness_per_form": lambda: completeness.completeness_per_form(rolled()),
        "completeness_per_form_version": lambda: completeness.completeness_per_form_version(rolled()),
        "completeness_per_element": lambda: completeness.completeness_per_element(completeness.present_forms(
            completeness.flagged_versions(*versions))),
        "empty_basic_forms": lambda: completeness.empty_forms(form_sums(), "basic"),
        "empty_longitudinal_forms": lambda: completeness.empty_forms(form_sums(), "longitudinal"),
        "report_rates": lambda: report.rule_rates(all_summaries(), rules["report_metadata"]),
        "report_sections": lambda: report.section_totals(all_summaries(SECTION_FAMILIES)),
        "report_relational": lambda: report.relational_checks(relational_counts()),
        "report_relational_totals": lambda: report.relational_totals(relational_counts()),
        "report_patient_histogram": lambda: report.patient_histogram(per_patient()),
        "profile_counts": lambda: profile.counts(known, long),
        "profile_unknown_ids": lambda: profile.unknown_ids(known, long),
        "profile_episodes": lambda: profile.episode_distribution(long),
        "profile_missing_ids": lambda: profile.missing_pid(long),
    }


def assess(long: DataFrame, tables: dict[str, DataFrame], out: str, dates_by: dict | None = None, names=None,
           as_csv: bool = False) -> list[str]:
    """Write every result of a long export, or those of ``names``, and return what was written.

    Results are Parquet tables ``out/<name>.parquet``, with ``as_csv`` also delimited files ``out/<name>``.
    """
    spark, folders, written = long.sparkSession, [], []

    def keep(df: DataFrame) -> DataFrame:
        folders.append(new_folder(spark))
        df = stored(df, folders[-1])
        release(spark)  # the disks hold the shuffles of one table at a time
        return df

    for name, make in results(long, tables, expected_of(tables), keep, dates_by or {}, names).items():
        if names is not None and name not in names:
            continue
        path = f"{out}/{name}.parquet"
        writers.write_table(make(), path)
        if as_csv:
            writers.write_csv(spark.read.parquet(path), f"{out}/{name}")
        written.append(name)
    for folder in folders:
        drop_folder(spark, folder)
    return written


def run(spark: SparkSession, folder: str, out: str, buckets: int | None = None, dates_by: dict | None = None,
        files: dict[str, str] = FILES, as_csv: bool = False) -> list[str]:
    """Read the files, store the long export once at ``out/long_export.parquet`` and write every result next to it."""
    tables = read_tables(spark, folder, files)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = tables["wide"]
    keys = clustered.bucket_keys(reshape.clean_identifiers(wide, tables["dictionary"])[0].select("PID"), buckets)
    stage = new_folder(spark)
    long = clustered.write_clustered(reshape.build_long(wide, tables["dictionary"], stage=stage),
                                     f"{out}/long_export.parquet", buckets, keys)
    drop_folder(spark, stage)
    return assess(long, tables, out, dates_by, as_csv=as_csv)
