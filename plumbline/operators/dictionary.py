"""Structural metadata: data dictionary, codebook and checks of the rule tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.text import strip, to_number

# Value types a longitudinal rule may have.
_VALUE_TYPES = fixed.INCREASING_TYPES + fixed.NUMERIC_TYPES + fixed.CATEGORICAL_TYPES


def rename_columns(elements: DataFrame) -> DataFrame:
    """P1."""
    return elements.withColumnsRenamed(fixed.ELEMENT_LIST_RENAMES)


def add_source_ids(elements: DataFrame) -> DataFrame:
    """Drop empty rows, build ``X_<form>_<record or 0>_<element>``."""
    part = lambda urn: F.get(F.split(urn, ":"), 3)
    rows = elements.dropna(how="all", subset=[c for c in elements.columns if c != "row_ord"])
    form = F.get(F.split("form_id", ":"), 0)
    record = F.when(F.col("record_urn").isNull(), F.lit("0")).otherwise(part(F.col("record_urn")))
    return rows.withColumn("source_id", F.concat(
        F.lit("X_"), form, F.lit("_"), record, F.lit("_"), part(F.col("dataelement_urn"))))


def first_per_source_id(elements: DataFrame) -> DataFrame:
    """The first row of each id in file order. An aggregate keeps one row per key and task."""
    rest = [c for c in elements.columns if c != "source_id"]
    return elements.groupBy("source_id").agg(*[F.min_by(c, "row_ord").alias(c) for c in rest])


def add_slots(elements: DataFrame, element_details: DataFrame) -> DataFrame:
    """P5: the slot of each element; one slot per URN, so the dictionary keeps its grain."""
    slots = element_details.filter("dataelement_urn is not null").groupBy("dataelement_urn").agg(
        F.min("slots").alias("slots"))
    return elements.join(slots, "dataelement_urn", "left")


def build_dictionary(element_list: DataFrame, element_details: DataFrame) -> DataFrame:
    """Raw element list to data dictionary."""
    return add_slots(first_per_source_id(add_source_ids(rename_columns(element_list))), element_details)


def check_rules(dictionary: DataFrame, date_rules: DataFrame, longitudinal_rules: DataFrame,
                import_rules: DataFrame, mappings: DataFrame) -> DataFrame:
    """Rule rows that cannot work, as (rule_table, rule_id, source_id, reason)."""
    types = dictionary.groupBy(strip(F.col("source_id")).alias("_id")).agg(
        F.min(F.lower(strip(F.col("form_type")))).alias("_type"))
    side = lambda name: types.select(F.col("_id").alias(f"_{name}_id"), F.col("_type").alias(f"_{name}_type"),
                                     F.lit(True).alias(f"_{name}_known"))

    def bad(table, rules, rule_id, source_id, reason):
        return rules.withColumn("reason", reason).filter("reason is not null").select(
            F.lit(table).alias("rule_table"), rule_id.alias("rule_id"), source_id.alias("source_id"), "reason")

    longitudinal = bad(
        "longitudinal_rules", longitudinal_rules, F.col("rule_id"), F.col("source_id"),
        F.when(to_number(F.col("allowed_variation_percent"), comma=False).isNull(), "allowed variation is no number")
        .when(~F.lower("value_type").isin(list(_VALUE_TYPES)), "unknown value type"))
    sources, targets = side("source"), side("target")
    imports = (
        import_rules.join(sources, import_rules["source_source_id"] == sources["_source_id"], "left")
        .join(targets, import_rules["target_source_id"] == targets["_target_id"], "left")
    )
    supported = (F.col("_target_type") == "longitudinal") & F.col("_source_type").isin("longitudinal", "basic")
    imports = bad(
        "import_rules", imports, F.col("rule_id"),
        F.when(F.col("_source_known").isNull(), F.col("source_source_id")).otherwise(F.col("target_source_id")),
        F.when(F.col("_source_known").isNull() | F.col("_target_known").isNull(), "id missing from the dictionary")
        .when(~F.coalesce(supported, F.lit(False)), "unsupported form types"))
    inputs = side("source")
    mapped = mappings.join(inputs, mappings["variable_source_id"] == inputs["_source_id"], "left")
    mapped = bad("calculation_mappings", mapped, F.col("calculation_id"), F.col("variable_source_id"),
                 F.when(F.col("_source_known").isNull(), "id missing from the dictionary"))
    references = date_rules.select(
        F.col("source_id").alias("_reference_id"), F.lower(strip(F.col("form_type"))).alias("_reference_type")).distinct()
    dates = None
    for flag in ("notBeforeVariable", "notAfterVariable"):
        active = date_rules.filter(F.lower(strip(F.col(flag))) == "true")
        joined = active.join(references, strip(active[f"{flag}_source_id"]) == references["_reference_id"], "left")
        basic_target = F.lower(strip(F.col("form_type"))) == "basic"
        part = bad("date_rules", joined, F.lit(flag), F.col("source_id"),
                   F.when(F.col("_reference_id").isNull(), "reference variable has no date rule")
                   .when(basic_target & (F.col("_reference_type") == "longitudinal"), "unsupported form types"))
        dates = part if dates is None else dates.unionByName(part)
    return longitudinal.unionByName(imports).unionByName(mapped).unionByName(dates)


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """S9, whatever the dictionary: rows of the rule tables by name that share a key with others, and tolerances that are
    no number, as (rule_table, rule_id, source_id, reason). A repeated key is reported once, as the key's texts."""
    nothing = F.lit(None).cast("string")
    parts = []
    for name, keys in fixed.RULE_TABLE_KEYS.items():
        if name not in tables:
            continue
        texts = {k: F.coalesce(strip(F.col(k)), F.lit("")).alias(k) for k in keys}
        repeated = tables[name].groupBy(*texts.values()).agg(F.count("*").alias("_n")).filter("_n > 1")
        by_source = keys == ("source_id",)
        parts.append(repeated.select(
            F.lit(name).alias("rule_table"), (nothing if by_source else F.concat_ws(" | ", *keys)).alias("rule_id"),
            (F.col("source_id") if by_source else nothing).alias("source_id"), F.lit("repeated key").alias("reason")))
    if "calculation_formulas" in tables:
        written = strip(F.col("tolerance"))
        bad = tables["calculation_formulas"].filter((written != "") & to_number(written, comma=False).isNull())
        parts.append(bad.select(
            F.lit("calculation_formulas").alias("rule_table"), F.col("calculation_type").alias("rule_id"),
            nothing.alias("source_id"), F.lit("tolerance is no number").alias("reason")))
    return reduce(DataFrame.unionByName, parts)
