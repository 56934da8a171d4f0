"""Temporal plausibility of date values against rules kept as data."""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.joins import key_join
from plumbline.functions.text import is_true, strip, to_date_any, to_date_in
from plumbline.operators.contract import make_summary, make_violation

_FLAGS = {
    "not_before_dob": "notBeforeDOB", "not_after_death": "notAfterDeath", "not_in_future": "notFuture",
    "not_after_episode": "notAfterEpisode", "not_before_variable": "notBeforeVariable",
    "not_after_variable": "notAfterVariable",
}
SIMPLE_RULES = ("not_before_dob", "not_after_death", "not_in_future", "not_after_episode")
VARIABLE_RULES = ("not_before_variable", "not_after_variable")
_NOT_BEFORE = ("not_before_dob", "not_before_variable")
# Death is off unless asked for: its flag column and source id are optional.
DEFAULT_RULES = ("not_before_dob", "not_in_future", "not_after_episode", *VARIABLE_RULES)


def prepare(export: DataFrame, rules: DataFrame, episode_formats=("DD/MM/YYYY",)) -> DataFrame:
    """Values of ruled variables with their rule, their parsed date and the episode's date."""
    rules = rules.drop("row_ord").withColumn("data_format", strip(F.col("data_format")))
    return export.join(F.broadcast(rules), "source_id").withColumns({
        "source_value_parsed": to_date_in(F.col("source_value"), F.col("data_format")),
        "episode_date_parsed": to_date_any(F.col("Episode_Date"), episode_formats),
    })


def known_variables(rules: DataFrame) -> DataFrame:
    """Form type and format of every ruled variable, by its first row where the table has an order, else its least."""
    found = F.struct(F.lower(strip(F.col("form_type"))).alias("type"), strip(F.col("data_format")).alias("format"))
    first = F.min_by(found, "row_ord") if "row_ord" in rules.columns else F.min(found)
    return rules.groupBy(F.col("source_id").alias("_reference")).agg(first.alias("_first")).select("_reference", "_first.*")


def with_questions(date_rules: DataFrame, rules, birth_id=None, death_id=None) -> DataFrame:
    """D7, rule side: every rule row with ``_questions``, the comparisons its values have to stand: rule id, variable to
    compare with, if any, and whether that is matched by episode.

    A basic reference is matched by patient, two longitudinal variables by patient and episode; a basic target with a
    longitudinal reference is not comparable and is not asked. Birth and death are references like others.
    """
    known, out, questions = known_variables(date_rules), date_rules, []

    def ask(rule_id, given, reference=F.lit(None).cast("string"), by_episode=F.lit(False)):
        questions.append(F.when(given, F.struct(
            F.lit(rule_id).alias("rule_id"), reference.alias("reference"), by_episode.alias("by_episode"))))

    for rule_id in (r for r in _FLAGS if r in rules):
        flag = _FLAGS[rule_id]
        if rule_id in VARIABLE_RULES:
            side = known.select(F.col("_reference").alias(f"_{flag}_id"), F.col("type").alias(f"_{flag}_type"))
            out = out.join(side, strip(F.col(f"{flag}_source_id")) == F.col(f"_{flag}_id"), "left")
            target, reference = F.lower(strip(F.col("form_type"))), F.col(f"_{flag}_type")
            grain = F.when(reference == "basic", F.lit(False)).when(
                (reference == "longitudinal") & (target == "longitudinal"), F.lit(True))
            ask(rule_id, is_true(F.col(flag)) & grain.isNotNull(), F.col(f"_{flag}_id"), grain)
        elif rule_id in ("not_before_dob", "not_after_death"):
            ask(rule_id, is_true(F.col(flag)), F.lit(birth_id if rule_id == "not_before_dob" else death_id).cast("string"))
        else:
            ask(rule_id, is_true(F.col(flag)))
    return out.select(*date_rules.columns, F.array_compact(F.array(*questions)).alias("_questions"))


def reference_index(export: DataFrame, date_rules: DataFrame, asked: DataFrame) -> DataFrame:
    """D4, D7, D11, data side: the first parsed date of every variable that a question refers to, in file order, per
    patient, or per patient and episode (``_episode``, else null). One aggregate for all references and both grains.

    What is wanted is as long as the rules. Spark takes a table derived by joins for large and would deal the whole
    export by element to a task each, so it is told to broadcast this one.
    """
    wanted = asked.select(F.explode("_questions").alias("q")).select(
        F.col("q.reference").alias("_reference"), F.col("q.by_episode").alias("_by_episode")).distinct()
    wanted = wanted.join(known_variables(date_rules), "_reference").withColumnRenamed("_reference", "source_id")
    return (
        export.join(F.broadcast(wanted), "source_id")
        .withColumn("_date", to_date_in(F.col("source_value"), F.col("format")))
        .filter("_date is not null")
        .groupBy(F.col("source_id").alias("_reference"), "PID",
                 F.when(F.col("_by_episode"), F.col("Episode")).alias("_episode"), "_by_episode")
        .agg(F.min_by("_date", F.struct("row_ord", "_date")).alias("_known"))
    )


def _by_grain(questions) -> Column:
    """Questions in at most two groups, those matched by episode and all others, each a struct of both."""
    groups = F.transform(F.array(F.lit(False), F.lit(True)), lambda grain: F.struct(
        grain.alias("by_episode"), F.filter(questions, lambda q: q["by_episode"] == grain).alias("questions")))
    return F.filter(groups, lambda g: F.size(g["questions"]) > 0)


def outcomes(export: DataFrame, date_rules: DataFrame, birth_id=None, death_id=None, as_of=None,
             rules=DEFAULT_RULES, episode_formats=("DD/MM/YYYY",)) -> DataFrame:
    """Every assessed (row, rule) pair with its ``violated`` flag.

    The export is read twice, for the values and for the index of references; all rules are one join. A value goes
    through that once per grain, with all its questions, and meets the references of its patient or episode as a map,
    which is as long as the rules.
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date") if isinstance(as_of, (str, date)) else as_of
    asked = with_questions(date_rules, rules, birth_id, death_id)
    prepared = prepare(export, asked, episode_formats).filter("source_value_parsed is not null")
    kept = [c for c in prepared.columns if c != "_questions"]
    rows = prepared.withColumn("_g", F.explode(_by_grain(F.col("_questions")))).select(
        *kept, F.col("_g.questions").alias("_questions"), F.col("_g.by_episode").alias("_by_episode"),
        F.when(F.col("_g.by_episode"), F.col("Episode")).alias("_episode"))
    rule, value = F.col("rule_id"), F.col("source_value_parsed")
    grain = ["PID", "_episode", "_by_episode"]
    dates = reference_index(export, date_rules, asked).groupBy(*grain).agg(
        F.map_from_entries(F.collect_list(F.struct("_reference", "_known"))).alias("_dates"))
    rows = key_join(rows, dates, grain, "left", null_safe=("PID", "_episode")).withColumn(
        "_q", F.explode("_questions")).select(
        *kept, "_q.rule_id", F.col("_q.reference").alias("_reference"),
        F.try_element_at("_dates", F.col("_q.reference")).alias("_known"))
    # Nobody's date of birth or death says nothing about rows without a patient.
    of_person = rule.isin("not_before_dob", "not_after_death")
    rows = rows.withColumn("_against", F.when(rule == "not_in_future", today).when(
        rule == "not_after_episode", F.col("episode_date_parsed")).when(
        ~of_person | F.col("PID").isNotNull(), F.col("_known"))).filter("_against is not null")
    shown = {}
    for rule_id, name in (("not_before_dob", "dob_parsed"), ("not_after_death", "death_parsed")):
        if rule_id in rules:
            shown[name] = F.when(rule == rule_id, F.col("_known"))
    if any(r in rules for r in VARIABLE_RULES):
        compared = rule.isin(list(VARIABLE_RULES))
        shown["comparison_source_id"] = F.when(compared, F.col("_reference"))
        shown["comparison_date_parsed"] = F.when(compared, F.col("_known"))
    return rows.select(
        *kept, *[c.alias(n) for n, c in shown.items()], "rule_id",
        F.when(rule.isin(list(_NOT_BEFORE)), value < F.col("_against")).otherwise(value > F.col("_against")).alias("violated"))


def violations(export: DataFrame, date_rules: DataFrame, **options) -> DataFrame:
    """All working columns of the failed rows plus the rule columns."""
    failed = outcomes(export, date_rules, **options).filter("violated").drop("violated")
    expected = F.create_map(*[F.lit(x) for pair in fixed.TEMPORAL_RULES for x in pair])
    return make_violation(failed, F.col("rule_id"), fixed.TEMPORAL_RULE_TYPE, expected[F.col("rule_id")],
                          F.col("source_value_parsed"))


def summary(export: DataFrame, date_rules: DataFrame, rules=DEFAULT_RULES, **options) -> DataFrame:
    """One row per rule."""
    counts = outcomes(export, date_rules, rules=rules, **options).withColumn("assessed", F.lit(True))
    return make_summary(counts, [(r, fixed.TEMPORAL_RULE_TYPE) for r, _ in fixed.TEMPORAL_RULES if r in rules])
