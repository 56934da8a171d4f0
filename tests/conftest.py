import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from plumbline.session import configure
from plumbline.sources.local import text_frame


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("plumbline-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame("a b", [("1", None)]): a DataFrame of texts; a column ``row_ord`` becomes a number."""
    def build(columns, rows):
        df = text_frame(spark, [tuple(None if v is None else str(v) for v in r) for r in rows], columns.split())
        return df.withColumn("row_ord", df["row_ord"].cast("bigint")) if "row_ord" in df.columns else df
    return build


@pytest.fixture(scope="session")
def rows():
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
    return collect
