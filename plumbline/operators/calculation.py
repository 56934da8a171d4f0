"""Calculation conformance: stored results against results recomputed from their recorded inputs."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.formulas import formula_column, formula_variables, uses_array_functions
from plumbline.functions.measures import round_exact, round_scaled
from plumbline.functions.joins import key_join
from plumbline.functions.text import to_number
from plumbline.operators.contract import with_zero_rows

RESULT_COLUMNS = (
    "PID", "episode_date", "calculation_id", "calculation_type", "score_label", "score_source_id", "IX",
    "stored_value", "expected_value", "difference", "tolerance", "formula_expression", "input_values",
    "status", "violation",
)
_CASE = ["PID", "episode_date", "IX"]


def numeric_values(rows: DataFrame) -> DataFrame:
    """K1: ``source_value_numeric``, null where the text is no number.

    Used after the join with the rules, so only the values that some calculation needs are read as numbers.
    """
    return rows.withColumnRenamed("Episode_Date", "episode_date").withColumn(
        "source_value_numeric", to_number(F.col("source_value")))


def resolved_instances(instances: DataFrame, formulas: DataFrame, mappings: DataFrame) -> DataFrame:
    """K2: instances with their formula and number of inputs; ``evaluated`` is false where either is missing.

    The default tolerance stands in for a missing column only: a blank cell means no check, other text stops the job.
    """
    missing = {"tolerance": F.lit(str(fixed.DEFAULT_TOLERANCE)), "rounding": F.lit(None).cast("string")}
    formulas = formulas.withColumns({c: v for c, v in missing.items() if c not in formulas.columns})
    tolerance = F.col("tolerance").try_cast("double")
    blank = F.col("tolerance").isNull() | (F.trim("tolerance") == "")
    counts = mappings.groupBy("calculation_id").agg(F.count("*").alias("n_inputs"))
    return (
        instances.join(formulas, "calculation_type", "left")
        .join(counts, "calculation_id", "left")
        .withColumns({
            "tolerance": F.when(blank | tolerance.isNotNull(), tolerance).otherwise(
                F.raise_error(F.concat(F.lit("invalid tolerance: "), F.col("calculation_type"))).cast("double")),
            "rounding": F.coalesce("rounding", F.lit("none")),
            "score_label": F.coalesce("score_label", "calculation_id"),
            "evaluated": F.col("formula_expression").isNotNull() & F.col("n_inputs").isNotNull(),
        })
    )


def input_values(export: DataFrame, mappings: DataFrame) -> DataFrame:
    """K3, data side: the smallest and largest number of every mapped variable (``_low0``, ``_high0``, ... in the order of
    :func:`mapped_variables`) per patient, episode date and repeat.

    One row serves all calculations, and ambiguity is seen from the two extremes, so a case is reduced to one row before
    the shuffle, whatever the number of calculations that read it.
    """
    variables = mapped_variables(mappings.collect())  # rule rows only
    of = lambda v: F.when(F.col("source_id") == v, F.col("source_value_numeric"))
    extremes = [f(of(v)).alias(f"_{name}{i}") for i, v in enumerate(variables)
                for name, f in (("low", F.min), ("high", F.max))]
    rows = numeric_values(export.filter(F.col("source_id").isin(variables)))
    return rows.groupBy(*_CASE).agg(*(extremes or [F.count("*").alias("_rows")]))


def mapped_variables(mapping_rows) -> list[str]:
    return sorted({r.variable_source_id for r in mapping_rows if r.variable_source_id is not None})


def input_map(mapping_rows) -> Column:
    """K3, rule side: the inputs of a row's calculation by alias; null where one is missing or ambiguous. An alias that
    is mapped twice leaves a calculation without cases."""
    at = {v: i for i, v in enumerate(mapped_variables(mapping_rows))}
    by_calculation: dict[str, list] = {}
    for row in mapping_rows:
        by_calculation.setdefault(row.calculation_id, []).append(row)
    inputs = F.lit(None).cast("map<string,double>")
    for calculation, rows in by_calculation.items():
        aliases = {r.variable_alias: at.get(r.variable_source_id) for r in rows}
        if calculation is None or len(aliases) < len(rows) or None in aliases.values():
            continue
        given = reduce(Column.__and__, [F.col(f"_low{i}") == F.col(f"_high{i}") for i in aliases.values()])
        pairs = [c for alias, i in sorted(aliases.items()) for c in (F.lit(alias), F.col(f"_low{i}"))]
        inputs = F.when((F.col("calculation_id") == calculation) & given, F.create_map(*pairs)).otherwise(inputs)
    return inputs


def expected_value(formulas) -> Column:
    """K4: CASE over the formula rows; each formula is built once and evaluated only for its own rows."""
    value = F.when(F.lit(False), F.lit(None).cast("double"))
    for row in formulas:
        inputs = F.col("input_values")
        complete = F.lit(True)
        for name in formula_variables(row.formula_expression):
            complete = complete & F.map_contains_key(inputs, F.lit(name))
        value = value.when(
            (F.col("calculation_type") == row.calculation_type) & complete,
            formula_column(row.formula_expression, lambda name: F.try_element_at(inputs, F.lit(name))))
    return value


def rounded(value: Column, rounding: Column, scaled: Column) -> Column:
    """K5: half-even rounding by name; whole-number rounding of a non-finite value has no result.

    ``scaled`` marks the rows whose formula yields a number that rounds by scaling.
    """
    out = F.when(F.lit(False), value)
    for name, scale in fixed.ROUNDING_SCALES.items():
        out = out.when(
            rounding == name,
            F.when(F.abs(value) < F.lit(float("inf")), F.rint(value)) if scale == 0 else
            F.when(scaled, round_scaled(value, scale)).otherwise(round_exact(value, scale)))
    return out.otherwise(value)


def results(export: DataFrame, instances: DataFrame, formulas: DataFrame, mappings: DataFrame) -> DataFrame:
    """K6, K7: every evaluated case with stored and expected value, inputs and verdict."""
    formula_rows = formulas.select("calculation_type", "formula_expression").collect()  # rule rows only
    types = [r.calculation_type for r in formula_rows]
    if len(set(types)) < len(types):
        raise ValueError(f"repeated calculation_type: {sorted(t for t in set(types) if types.count(t) > 1)}")
    active = resolved_instances(instances, formulas, mappings).filter("evaluated")
    # Rule tables are short, but Spark takes tables derived by joins for large unless it is told. What follows from a rule
    # alone joins the cases after their shuffle.
    scored = F.broadcast(active.select(F.col("score_source_id").alias("source_id")).distinct())
    stored = numeric_values(export.join(scored, "source_id", "left_semi")).filter(
        F.col("source_value_numeric").isNotNull()).select(*_CASE, "source_id", "source_value_numeric")
    cases = key_join(stored, input_values(export, mappings), _CASE, null_safe=("episode_date",)).join(
        F.broadcast(active.withColumn("source_id", F.col("score_source_id"))), "source_id").withColumn(
        "input_values", input_map(mappings.collect()))
    scaled = F.col("calculation_type").isin(
        [r.calculation_type for r in formula_rows if uses_array_functions(r.formula_expression)])
    difference = F.abs(F.col("stored_value") - F.col("expected_value"))
    broken = F.coalesce(~F.isnan("difference") & (F.col("difference") > F.col("tolerance")), F.lit(False))
    return (
        cases.filter("input_values is not null")
        .withColumn("stored_value", F.col("source_value_numeric"))
        # Exploding a one-element array computes the formula once per row; as a plain column it would be copied
        # into every expression that uses it, and the generated code would outgrow the JVM's method limit.
        .withColumn("_raw", F.explode(F.array(expected_value(formula_rows))))
        .withColumn("expected_value", rounded(F.col("_raw"), F.col("rounding"), scaled))
        .filter("expected_value is not null")
        .withColumn("difference", difference)
        .withColumn("violation", broken)
        .withColumn("status", F.when(F.col("violation"), "violation").otherwise("pass"))
        .select(*RESULT_COLUMNS)
    )


def violations(case_results: DataFrame) -> DataFrame:
    return case_results.filter("violation")


def summary(case_results: DataFrame, instances: DataFrame, formulas: DataFrame, mappings: DataFrame) -> DataFrame:
    """K8: one row per instance; skipped instances have their own rule type and zeros."""
    counts = case_results.groupBy(F.col("calculation_id").alias("rule_id")).agg(
        F.count("*").alias("assessed_elements"), F.count_if("violation").alias("total_violations"))
    rules = resolved_instances(instances, formulas, mappings).select(
        F.when(F.col("evaluated"), fixed.CALCULATION_RULE_TYPE)
        .otherwise(fixed.CALCULATION_SKIPPED_RULE_TYPE).alias("rule_type"),
        F.col("calculation_id").alias("rule_id"))
    return with_zero_rows(rules, counts, "rule_id").select(
        "rule_type", "rule_id", "assessed_elements", "total_violations")
