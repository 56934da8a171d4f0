"""Form versions: items of each form, their resolution to elements, and the elements a patient should have."""

from pyspark.sql import DataFrame, functions as F

from plumbline import fixed_values as fixed

ELEMENT_COLUMNS = (
    "form_key", "form_id", "form_version", "form_label", "type", "record_urn", "dataelement_urn", "source_id",
    "mandatory", "repeatable", "position", "resolution_status",
)


def form_items(forms: DataFrame) -> DataFrame:
    """one row per element or record item of a form version; other items are left out."""
    item_id = F.col("item.mdrId")
    kind = F.when(item_id.contains("dataelement"), "dataelement").when(item_id.contains("record"), "record")
    return forms.select("form_key", "form", F.explode("form.items").alias("item")).select(
        "form_key",
        F.col("form.id").alias("form_id"),
        F.col("form.version").alias("form_version"),
        F.coalesce(F.nullif("form.label", F.lit("")), "form.name").alias("form_label"),
        item_id.alias("urn"),
        kind.alias("type"),
        F.col("item.label").alias("element_label"),
        F.col("item.mandatory").alias("mandatory"),
        F.col("item.repeatable").alias("repeatable"),
        F.col("item.position").alias("position"),
    ).filter("type is not null")


def _dictionary_forms(dictionary: DataFrame) -> DataFrame:
    return dictionary.withColumn("form_id", F.split_part(F.col("form_id"), F.lit(":"), F.lit(1)))


def keep_dictionary_forms(items: DataFrame, dictionary: DataFrame) -> DataFrame:
    """items of forms the dictionary knows."""
    return items.join(_dictionary_forms(dictionary).select("form_id").distinct(), "form_id", "left_semi")


def _status(kind: str):
    return F.when(F.col("source_id").isNotNull(), f"{kind}_resolved").otherwise(f"{kind}_unresolved")


def resolve_elements(items: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Items as elements with their ``source_id``; records become all their elements."""
    items = keep_dictionary_forms(items, dictionary).withColumn("type", F.lower("type"))
    known = _dictionary_forms(dictionary)
    direct = (
        items.filter("type = 'dataelement'").withColumnRenamed("urn", "dataelement_urn")
        .join(known.select("form_id", "dataelement_urn", "source_id").distinct(),
              ["form_id", "dataelement_urn"], "left")
        .withColumns({"record_urn": F.lit(None).cast("string"), "resolution_status": _status("direct")})
    )
    records = (
        items.filter("type = 'record'").withColumnRenamed("urn", "record_urn")
        .join(known.select("form_id", "record_urn", "dataelement_urn", "source_id"),
              ["form_id", "record_urn"], "left")
        .withColumn("resolution_status", _status("record"))
    )
    return direct.select(*ELEMENT_COLUMNS).unionByName(records.select(*ELEMENT_COLUMNS))


def resolved(elements: DataFrame) -> DataFrame:
    return elements.filter("source_id is not null")


def unresolved(elements: DataFrame) -> DataFrame:
    return elements.filter("source_id is null")


def _expected(versions: DataFrame, elements: DataFrame, form_type: str) -> DataFrame:
    versions = versions.withColumnsRenamed(
        {"version": "form_version", "episode_name": "episode_date", "patient_id": "PID"})
    return versions.join(elements, ["form_id", "form_version"], "left").withColumn("form_type", F.lit(form_type))


def expected_versions(basic_versions: DataFrame, longitudinal_versions: DataFrame) -> DataFrame:
    """F6, patient side: the form versions each patient, or patient and episode, has, before their elements join."""
    renamed = lambda versions, form_type: versions.withColumnsRenamed(
        {"version": "form_version", "episode_name": "episode_date", "patient_id": "PID"}).withColumn(
        "form_type", F.lit(form_type))
    return renamed(basic_versions, "basic").unionByName(
        renamed(longitudinal_versions, "longitudinal"), allowMissingColumns=True)


def expected_elements(basic_versions: DataFrame, longitudinal_versions: DataFrame, elements: DataFrame) -> DataFrame:
    """Elements each patient, or patient and episode, should have.

    A patient-form whose version is unknown stays, with null element columns.
    """
    basic = _expected(basic_versions, elements, "basic")
    longitudinal = _expected(longitudinal_versions, elements, "longitudinal")
    return basic.unionByName(longitudinal, allowMissingColumns=True)


def form_versions_present(expected: DataFrame) -> DataFrame:
    """F9."""
    return expected.select("form_id", "form_version").distinct().orderBy("form_id", "form_version")


def expected_summary(items: DataFrame, elements: DataFrame, expected: DataFrame) -> DataFrame:
    """ten counts as (metric, value)."""
    item_counts = items.agg(
        F.count_distinct(F.struct("form_id", "form_version")).alias("m0"),
        F.count("*").alias("m1"),
        F.count_if(F.lower("type") == "dataelement").alias("m2"),
        F.count_if(F.lower("type") == "record").alias("m3"),
    )
    element_counts = elements.agg(
        F.count("source_id").alias("m4"),
        F.count_if(F.col("source_id").isNull()).alias("m5"),
        F.count("source_id").alias("m6"),
    )
    expected_counts = expected.agg(
        F.count_if(F.col("form_type") == "basic").alias("m7"),
        F.count_if(F.col("form_type") == "longitudinal").alias("m8"),
        F.count("*").alias("m9"),
    )
    names = F.create_map(*[F.lit(x) for i, name in enumerate(fixed.EXPECTED_METRICS) for x in (f"m{i}", name)])
    parts = [c.unpivot([], list(c.columns), "m", "value") for c in (item_counts, element_counts, expected_counts)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(names[F.col("m")].alias("metric"), "value")
