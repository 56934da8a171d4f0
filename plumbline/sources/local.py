"""Small tables that live in the program."""

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession


def text_frame(spark: SparkSession, rows, columns) -> DataFrame:
    """Rows of texts as a DataFrame.

    Arrow data becomes a local relation: its size is known, so Spark broadcasts it in joins, and no Python
    worker is started for it.
    """
    cells = list(zip(*rows)) if rows else [()] * len(columns)
    table = pa.table({c: pa.array(list(v), pa.string()) for c, v in zip(columns, cells)})
    return spark.createDataFrame(table)
