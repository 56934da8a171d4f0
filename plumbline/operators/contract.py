"""The two result shapes every check family shares: violations and summaries."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions.measures import count_where
from plumbline.sources.local import text_frame

SUMMARY_SCHEMA = "rule_type string, rule_id string, assessed_elements bigint, total_violations bigint"


def make_violation(df: DataFrame, rule_id, rule_type, expected, observed: Column, columns=None) -> DataFrame:
    """Q1: add the rule columns; with ``columns`` the result has exactly these, absent ones as null."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = df.withColumns({
        "rule_id": as_column(rule_id),
        "rule_type": as_column(rule_type),
        "expected": as_column(expected),
        "observed": observed.cast("string"),
    })
    if columns is None:
        return out
    return out.select(*[
        F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns
    ])


def make_summary(flags: DataFrame, rules) -> DataFrame:
    """Q2: one row per rule of ``rules`` [(rule_id, rule_type)], also where nothing was assessed.

    ``flags`` has ``rule_id``, ``assessed`` and ``violated`` per checked unit, or per pre-counted group
    when these two are numbers.
    """
    counted = flags.schema["assessed"].dataType.typeName() != "boolean"
    assessed = F.sum("assessed") if counted else count_where(F.col("assessed"))
    violated = F.sum("violated") if counted else count_where(F.col("violated"))
    found = flags.groupBy("rule_id").agg(
        assessed.cast("bigint").alias("assessed_elements"),
        violated.cast("bigint").alias("total_violations"),
    )
    return with_zero_rows(rule_frame(flags.sparkSession, rules), found, "rule_id").select(
        "rule_type", "rule_id", "assessed_elements", "total_violations")


def rule_frame(spark: SparkSession, rules) -> DataFrame:
    return text_frame(spark, rules, ("rule_id", "rule_type"))


def with_zero_rows(rules: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Attach counts to a rule table; rules without a row get zeros."""
    counts = [c for c in found.columns if c != key]
    return rules.join(found, key, "left").withColumns(
        {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})


def one_summary(df: DataFrame, rule_id: str, rule_type: str, assessed: Column, violated: Column) -> DataFrame:
    """Summary row of a single rule from one ungrouped aggregate."""
    return df.agg(
        F.lit(rule_type).alias("rule_type"),
        F.lit(rule_id).alias("rule_id"),
        F.coalesce(assessed, F.lit(0)).cast("bigint").alias("assessed_elements"),
        F.coalesce(violated, F.lit(0)).cast("bigint").alias("total_violations"),
    )
