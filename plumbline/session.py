"""Session settings and the shared folder for cut lineage."""

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on. All are Spark defaults except the skew factor: with it AQE splits a
# shuffle partition once it is three times the median, so a hot patient in a row-level join is spread.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the one set on the context.

    Where a session names none, a folder in its warehouse is taken, which Spark itself requires to be shared.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    named = named or context.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_shared").rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder, so later stages survive lost executors and nothing is computed again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def new_folder(spark: SparkSession) -> str:
    """Name of a new folder below the shared one."""
    return f"{shared_folder(spark)}/plumbline-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write as Parquet to a new folder below the shared one and read it back: like ``cut_lineage``, but compressed."""
    path = path or new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``new_folder`` whose table is read no more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Have shuffle files removed that only finished, cut plans needed.

    Spark removes a shuffle's files when the driver's garbage collection finds that no plan refers to it. A driver that
    makes little garbage may not get there for half an hour, and all shuffles of a long job would share the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
