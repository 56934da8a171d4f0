"""Writers."""

from pyspark.sql import DataFrame, functions as F


def _flat(df: DataFrame) -> DataFrame:
    """Maps and structs as JSON text, the row order left out: a delimited file holds plain text only."""
    nested = {f.name: F.to_json(f.name) for f in df.schema.fields
              if f.name != "row_ord" and f.dataType.typeName() in ("map", "struct", "array")}
    return df.drop("row_ord").withColumns(nested)


def write_csv(df: DataFrame, path: str, sep: str = ";", quote_all: bool = False) -> None:
    """Delimited result. Booleans and numbers as Spark prints them, null as an empty field."""
    _flat(df).write.mode("overwrite").option("header", True).option("sep", sep).option(
        "quoteAll", quote_all).option("nullValue", "").option("emptyValue", "").csv(path)


def write_long_parquet(long: DataFrame, path: str) -> None:
    """Long export for the checks, range-clustered by element and patient.

    Most checks read a few elements only; clustering lets the scan skip the rest by file and row-group
    statistics. Range partitioning also cuts an element with very many rows into several files.
    """
    keys = ["source_id", "PID", *(["row_ord"] if "row_ord" in long.columns else [])]
    long.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Any result or stage table, as parquet."""
    df.write.mode("overwrite").parquet(path)
