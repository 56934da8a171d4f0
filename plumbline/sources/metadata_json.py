"""Nested metadata documents as flat tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Shape of a form document and of an element document.
FORMS_TYPE = (
    "map<string, struct<id: string, version: string, label: string, name: string, items: array<struct<"
    "mdrId: string, label: string, mandatory: string, repeatable: string, position: string>>>>"
)
ELEMENT_TYPE = (
    "struct<identification: struct<urn: string, status: string>,"
    " designations: array<struct<language: string, designation: string, definition: string>>,"
    " validation: struct<datatype: string, format: string, permissible_values: array<struct<value: string,"
    " meanings: array<struct<language: string, designation: string, definition: string>>>>>,"
    " slots: array<struct<slot_value: string>>>"
)
SEARCH_TYPE = "struct<results: array<struct<type: string, identification: struct<urn: string>>>>"


def parse_forms(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per form version from documents that map a form key to a form."""
    return documents.select(F.explode(F.from_json(column, FORMS_TYPE)).alias("form_key", "form"))


def read_forms(spark: SparkSession, path: str) -> DataFrame:
    """Form definitions, one JSON object per file."""
    return parse_forms(spark.read.text(path, wholetext=True))


def _part_from_end(urn: Column, back: int) -> Column:
    return F.try_element_at(F.split(urn, ":"), F.lit(-back))


def select_elements(documents: DataFrame, column: str = "value") -> DataFrame:
    """URNs of the data elements in search results, with element id and version."""
    results = documents.select(F.explode(F.from_json(column, SEARCH_TYPE)["results"]).alias("r"))
    urn = F.col("r.identification.urn")
    return results.filter((F.col("r.type") == "DATAELEMENT") & urn.isNotNull() & (urn != "")).select(
        urn.alias("dataelement_urn"),
        _part_from_end(urn, 2).alias("dataelement_id"),
        _part_from_end(urn, 1).alias("dataelement_version"),
    )


def parse_elements(documents: DataFrame, column: str = "value") -> DataFrame:
    """Element documents as a struct, with id and version from the URN."""
    parsed = documents.select(F.from_json(column, ELEMENT_TYPE).alias("e"))
    urn = F.col("e.identification.urn")
    return parsed.select("e", _part_from_end(urn, 2).alias("dataelement_id"),
                         _part_from_end(urn, 1).alias("dataelement_version"))


def _first(array: str) -> Column:
    return F.get(F.col(array), 0)


def flatten_elements(elements: DataFrame) -> DataFrame:
    """One row per element with its first designation and first slot."""
    named = _first("e.designations")
    return elements.select(
        "dataelement_id", "dataelement_version",
        F.col("e.identification.urn").alias("dataelement_urn"),
        F.col("e.identification.status").alias("status"),
        named["language"].alias("language"),
        named["designation"].alias("dataelement_designation"),
        named["definition"].alias("dataelement_definition"),
        F.col("e.validation.datatype").alias("datatype"),
        F.col("e.validation.format").alias("format"),
        _first("e.slots")["slot_value"].alias("slots"),
    )


def codebook(elements: DataFrame) -> DataFrame:
    """One row per permissible value of enumerated elements, with its first meaning."""
    meaning = F.get(F.col("pv.meanings"), 0)
    return (
        elements.filter(F.col("e.validation.datatype") == "enumerated")
        .select("*", F.explode("e.validation.permissible_values").alias("pv"))
        .select(
            "dataelement_id", "dataelement_version",
            F.col("e.identification.urn").alias("dataelement_urn"),
            F.coalesce("pv.value", F.lit("None")).alias("pv_value"),
            meaning["language"].alias("pv_language"),
            meaning["designation"].alias("pv_designation"),
            meaning["definition"].alias("pv_definition"),
            _first("e.slots")["slot_value"].alias("pv_selection"),
        )
    )
