"""Value conformance: type, date format, permissible values and single choice.

A row's logical type decides which one of the first five rules applies, so all five are a single pass with a
``CASE`` and no explode. Single choice needs one count per patient, episode and element.
"""

from pyspark.sql import DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.joins import key_join
from plumbline.functions.text import (
    VALUE_DATE_FORMATS, has_value, is_integer_text, is_number_text, is_true, strip, to_date_in,
)
from plumbline.operators.contract import make_summary, make_violation

DICTIONARY_COLUMNS = (
    "source_id", "dataelement_designation", "dataelement_urn", "record_designation", "record_urn", "data_type",
    "data_format", "record_mandatory", "dataelement_mandatory", "record_repeatable", "dataelement_repeatable",
    "slots",
)
VIOLATION_COLUMNS = (
    "PID", "Episode_Date", "source_id", "dataelement_designation", "source_value",
    "rule_id", "rule_type", "expected", "observed",
)
_RULES = {kind: (rule_id, rule_type, expected) for kind, rule_id, rule_type, expected in fixed.VALUE_RULES}
SUMMARY_RULES = [(rule_id, rule_type) for _, rule_id, rule_type, _ in fixed.VALUE_RULES] + [
    fixed.SINGLE_CHOICE_RULE[:2]]
# Formats tried where the dictionary names one that is not known.
_FALLBACK_FORMATS = ("DD.MM.YYYY", "YYYY-MM-DD", "DD/MM/YYYY", "MM-DD-YYYY", "MM.YYYY", "MM-YYYY")


def enrich(export: DataFrame, dictionary: DataFrame) -> DataFrame:
    """V1: attach the dictionary's rule columns. No hint: Spark broadcasts the dictionary if its size allows.

    What follows from the dictionary alone is worked out here, once per element: the logical type ``_kind``,
    the clean date format ``_format`` and whether the element is assessed for ``_single_choice``.
    """
    one_choice = strip(F.coalesce("slots", F.lit(""))).isin(list(fixed.SINGLE_CHOICE_SLOTS))
    repeats = is_true(F.col("record_repeatable")) | is_true(F.col("dataelement_repeatable"))
    kind = F.upper(strip(F.col("data_type")))
    elements = dictionary.select(
        *DICTIONARY_COLUMNS,
        kind.alias("_kind"),
        strip(F.col("data_format")).alias("_format"),
        F.coalesce((kind == "ENUMERATED") & one_choice & ~repeats, F.lit(False)).alias("_single_choice"))
    return export.join(elements, "source_id", "left")


def _allowed(codebook: DataFrame) -> DataFrame:
    return codebook.select(
        "dataelement_urn", strip(F.col("pv_value")).alias("_clean"), F.lit(True).alias("_known")).distinct()


def value_outcomes(enriched: DataFrame, codebook: DataFrame, kinds=tuple(_RULES)) -> DataFrame:
    """V2-V6: every assessed row with its ``rule_id`` and ``violated`` flag."""
    text = F.col("source_value")
    rows = enriched.filter(F.col("_kind").isin(list(kinds)) & has_value(text))
    if "ENUMERATED" in kinds:
        rows = rows.withColumn("_clean", F.when(F.col("_kind") == "ENUMERATED", strip(text)))
        rows = rows.join(_allowed(codebook), ["dataelement_urn", "_clean"], "left").drop("_clean")
    else:
        rows = rows.withColumn("_known", F.lit(None).cast("boolean"))
    conforms = {
        "INTEGER": is_integer_text(text),
        "FLOAT": is_number_text(text),
        "BOOLEAN": F.upper(strip(text)).isin("TRUE", "FALSE"),
        "DATE": to_date_in(text, F.col("_format"), VALUE_DATE_FORMATS, otherwise=_FALLBACK_FORMATS).isNotNull(),
        "ENUMERATED": F.coalesce("_known", F.lit(False)),
    }
    ok, rule = F.when(F.lit(False), F.lit(True)), F.when(F.lit(False), F.lit(""))
    for kind in kinds:
        ok = ok.when(F.col("_kind") == kind, conforms[kind])
        rule = rule.when(F.col("_kind") == kind, F.lit(_RULES[kind][0]))
    return rows.withColumns({"violated": ~F.coalesce(ok, F.lit(False)), "rule_id": rule}).drop("_known")


def value_violations(enriched: DataFrame, codebook: DataFrame, kinds=tuple(_RULES)) -> DataFrame:
    """V2-V6: the rows that break their rule."""
    failed = value_outcomes(enriched, codebook, kinds).filter("violated")
    rule_type, expected = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for kind in kinds:
        _, type_text, expected_text = _RULES[kind]
        shown = F.lit(expected_text)
        if kind == "DATE":
            shown = F.concat(shown, F.coalesce("data_format", F.lit("nan")))
        rule_type = rule_type.when(F.col("_kind") == kind, F.lit(type_text))
        expected = expected.when(F.col("_kind") == kind, shown)
    return make_violation(failed, F.col("rule_id"), rule_type, expected, F.col("source_value"), VIOLATION_COLUMNS)


def _single_choice_rows(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("_single_choice") & has_value(F.col("source_value")))


def _single_choice_groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("PID", "Episode", "source_id").agg(F.count("*").alias("n_values"))


def single_choice_violations(enriched: DataFrame) -> DataFrame:
    """V7: every row of a group that holds more than one value; null episodes form groups too.

    Counting first and joining the few bad groups back keeps a hot group out of a window's single task.
    """
    rows = _single_choice_rows(enriched)
    bad = _single_choice_groups(rows).filter("n_values > 1")
    keys = ["PID", "Episode", "source_id"]
    failed = key_join(rows, bad, keys, null_safe=("PID", "Episode"))
    rule_id, rule_type, expected = fixed.SINGLE_CHOICE_RULE
    return make_violation(failed, rule_id, rule_type, expected, F.col("n_values"), VIOLATION_COLUMNS)


def violations(export: DataFrame, dictionary: DataFrame, codebook: DataFrame) -> DataFrame:
    """V8: violations of all six rules."""
    enriched = enrich(export, dictionary)
    return value_violations(enriched, codebook).unionByName(single_choice_violations(enriched))


def summary(export: DataFrame, dictionary: DataFrame, codebook: DataFrame) -> DataFrame:
    """V8: assessed and violating units of all six rules.

    Single choice assesses groups but counts violating rows.
    """
    enriched = enrich(export, dictionary)
    per_row = value_outcomes(enriched, codebook).groupBy("rule_id").agg(
        F.count("*").alias("assessed"), F.count_if("violated").alias("violated"))
    groups = _single_choice_groups(_single_choice_rows(enriched)).agg(
        F.lit(fixed.SINGLE_CHOICE_RULE[0]).alias("rule_id"),
        F.count("*").alias("assessed"),
        F.coalesce(F.sum(F.when(F.col("n_values") > 1, F.col("n_values"))), F.lit(0)).alias("violated"),
    )
    return make_summary(per_row.unionByName(groups), SUMMARY_RULES)
