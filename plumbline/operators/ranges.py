"""Numeric range conformance. The range text of a rule is read once, on the rule table."""

from pyspark.sql import DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.text import strip, to_number
from plumbline.operators.contract import make_violation, one_summary

# Fixed value: a range reads "low < X < high"; either side may be absent and "<" may be "<=".
_RANGE = r"\A(?:(-?[0-9]+(?:\.[0-9]+)?)(<=|<))?X(?:(<=|<)(-?[0-9]+(?:\.[0-9]+)?))?\z"


def numeric_rules(dictionary: DataFrame) -> DataFrame:
    """Dictionary rows of numeric type."""
    kind = F.upper(strip(F.col("data_type")))
    return dictionary.withColumn("data_type", kind).filter(F.col("data_type").isin("INTEGER", "FLOAT")).select(
        "source_id", "data_type", "data_format", "dataelement_designation", "dataelement_urn",
        "record_designation", "record_urn")


def parse_ranges(rules: DataFrame) -> DataFrame:
    """R2: add ``low, low_included, high, high_included``; all null where the format names no range."""
    shown = F.upper(F.replace(F.col("data_format"), F.lit(" "), F.lit("")))
    part = lambda group: F.nullif(F.regexp_extract(shown, _RANGE, group), F.lit(""))
    return rules.withColumns({
        "low": part(1).cast("double"),
        "low_included": part(2) == "<=",
        "high": part(4).cast("double"),
        "high_included": part(3) == "<=",
    })


def range_outcomes(export: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Every assessed value with its ``violated`` flag."""
    rules = parse_ranges(numeric_rules(dictionary)).filter("low is not null or high is not null").select(
        "source_id", "data_type", "data_format", "low", "low_included", "high", "high_included")
    number = F.col("numeric_value")
    below = (number < F.col("low")) | ((number == F.col("low")) & ~F.col("low_included"))
    above = (number > F.col("high")) | ((number == F.col("high")) & ~F.col("high_included"))
    return (
        export.join(rules, "source_id")
        .withColumn("numeric_value", to_number(F.col("source_value")))
        .filter(number.isNotNull())
        .withColumn("violated", F.coalesce(below, F.lit(False)) | F.coalesce(above, F.lit(False)))
    )


def violations(export: DataFrame, dictionary: DataFrame) -> DataFrame:
    failed = range_outcomes(export, dictionary).filter("violated").select(
        *export.columns, "data_type", "data_format", "numeric_value")
    return make_violation(failed, *fixed.RANGE_VIOLATION_RULE, F.col("source_value"))


def summary(export: DataFrame, dictionary: DataFrame) -> DataFrame:
    return one_summary(range_outcomes(export, dictionary), *fixed.RANGE_SUMMARY_RULE,
                       F.count("*"), F.count_if("violated"))
