"""Inspection of a dictionary and an export: counts and distributions."""

from pyspark.sql import DataFrame, functions as F

from plumbline.functions.measures import percent
from plumbline.functions.joins import key_join
from plumbline.functions.text import strip


def counts(dictionary: DataFrame, export: DataFrame) -> DataFrame:
    """Rows and distinct ids of both tables, as (metric, value)."""
    of_dictionary = dictionary.agg(
        F.count("*").alias("dictionary_rows"),
        F.count_distinct("source_id").alias("dictionary_source_ids"),
        F.count_distinct("dataelement_urn").alias("dictionary_element_urns"),
    )
    of_export = export.agg(
        F.count("*").alias("export_rows"),
        F.count_distinct("PID").alias("export_patients"),
        F.count_distinct("source_id").alias("export_source_ids"),
    )
    tall = lambda df: df.unpivot([], list(df.columns), "metric", "value")
    return tall(of_dictionary).unionByName(tall(of_export))


def repeated_urns(dictionary: DataFrame) -> DataFrame:
    """Ids of elements that occur more than once. Counted first, joined back after."""
    repeated = dictionary.groupBy("dataelement_urn").agg(F.count("*").alias("_n")).filter("_n > 1")
    return key_join(
        dictionary.select("dataelement_urn", "source_id"), repeated, ["dataelement_urn"], "left_semi",
        null_safe=["dataelement_urn"],
    ).orderBy("dataelement_urn", "source_id")


def _once(dictionary: DataFrame, key: str, columns) -> DataFrame:
    """One row per key: the first in file order where one is recorded."""
    order = F.col("row_ord") if "row_ord" in dictionary.columns else F.struct(*columns)
    return dictionary.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in columns])


def type_distribution(dictionary: DataFrame, key: str = "dataelement_urn") -> DataFrame:
    """Elements per data type with their share, counting every ``key`` once."""
    per_type = _once(dictionary, key, ["data_type"]).groupBy("data_type").agg(F.count("*").alias("n_elements"))
    total = per_type.agg(F.sum("n_elements"))
    return per_type.withColumn("percentage", percent(F.col("n_elements"), total.scalar(), 1)).orderBy(
        F.desc("n_elements"), "data_type")


def type_formats(dictionary: DataFrame) -> DataFrame:
    """Distinct pairs of type and format."""
    return dictionary.select("data_type", "data_format").distinct().orderBy("data_type", "data_format")


def format_distribution(dictionary: DataFrame, data_type: str = None, column: str = "data_format") -> DataFrame:
    """Elements per type and format (or slot), of one type or of all, every URN once."""
    rows = dictionary if data_type is None else dictionary.filter(F.col("data_type") == data_type)
    return _once(rows, "dataelement_urn", ["data_type", column]).groupBy("data_type", column).agg(
        F.count("*").alias("n_elements")).orderBy("data_type", F.desc("n_elements"), column)


def forms(dictionary: DataFrame) -> DataFrame:
    """One row per form."""
    return _once(dictionary, "form_id", ["Form", "form_type"]).filter("form_id is not null or Form is not null")


def forms_by_type(dictionary: DataFrame) -> DataFrame:
    """N6."""
    return forms(dictionary).groupBy("form_type").agg(F.count("*").alias("n_forms")).orderBy(
        F.desc("n_forms"), "form_type")


def elements_per_form(dictionary: DataFrame) -> DataFrame:
    """N6."""
    return dictionary.groupBy("form_id", "Form", "form_type").agg(
        F.count_distinct("source_id").alias("n_elements")).orderBy(F.desc("n_elements"), "form_id")


def episodes_per_patient(export: DataFrame) -> DataFrame:
    """N7."""
    return export.filter("PID is not null and Episode_Date is not null").groupBy("PID").agg(
        F.count_distinct("Episode_Date").alias("n_episodes"))


def episode_distribution(export: DataFrame) -> DataFrame:
    """Patients by number of episodes."""
    return episodes_per_patient(export).groupBy("n_episodes").agg(F.count("*").alias("n_patients")).orderBy("n_episodes")


def episode_describe(export: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, from the distribution rather than the patients."""
    n, weight = F.col("n_episodes").cast("double"), F.col("n_patients")
    quartile = lambda q: F.percentile(n, q, weight)
    total, first, second = F.sum(weight), F.sum(n * weight), F.sum(n * n * weight)
    squares = second - F.try_divide(first * first, total)
    return episode_distribution(export).agg(
        F.coalesce(total, F.lit(0)).alias("count"),
        F.try_divide(first, total).cast("double").alias("mean"),
        F.when(total > 1, F.sqrt(squares / (total - 1))).alias("std"),
        F.min(n).cast("double").alias("min"),
        quartile(0.25).alias("q25"), quartile(0.5).alias("q50"), quartile(0.75).alias("q75"),
        F.max(n).cast("double").alias("max"),
        F.coalesce(first, F.lit(0)).cast("bigint").alias("n_patient_episodes"),
    )


def missing_pid(export: DataFrame) -> DataFrame:
    """N8."""
    return export.agg(F.count_if(F.col("PID").isNull()).alias("n_missing_patient_ids"), F.count("*").alias("n_rows"))


def unknown_ids(dictionary: DataFrame, export: DataFrame) -> DataFrame:
    """Exported ids the dictionary lacks."""
    ids = lambda df: df.filter("source_id is not null").select(strip(F.col("source_id")).alias("source_id"))
    return ids(export).subtract(ids(dictionary))


def records(dictionary: DataFrame) -> DataFrame:
    """One row per record."""
    return _once(dictionary.filter("record_urn is not null"), "record_urn",
                 ["record_designation", "record_mandatory", "record_repeatable"]).orderBy("record_urn")


def record_nulls(dictionary: DataFrame) -> DataFrame:
    """Rows without and with a record, and the number of records."""
    return dictionary.agg(
        F.count_if(F.col("record_urn").isNull()).alias("n_without_record"),
        F.count("record_urn").alias("n_with_record"),
        F.count_distinct("record_urn").alias("n_records"))


def records_per_form(dictionary: DataFrame) -> DataFrame:
    """Records of every form, 0 where it has none."""
    keys = ["form_id", "Form", "form_type"]
    found = dictionary.filter("record_urn is not null").groupBy(*keys).agg(
        F.count_distinct("record_urn").alias("n_records"))
    known = forms(dictionary)
    return key_join(known, found, keys, "left", null_safe=keys).select(
        *keys, F.coalesce("n_records", F.lit(0)).alias("n_records"),
    ).orderBy(F.desc("n_records"), "form_id")


def record_usage(dictionary: DataFrame) -> DataFrame:
    """Elements and forms of every record."""
    return dictionary.filter("record_urn is not null").groupBy("record_urn", "record_designation").agg(
        F.count_distinct("source_id").alias("n_elements"),
        F.count_distinct("form_id").alias("n_forms")).orderBy(F.desc("n_elements"), "record_urn")
