"""Small helpers that several operators share."""

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import cut_lineage, stored

BLOCK_BYTES = 4 << 20  # text that a worker holds as Python objects at a time


def reachable(spark) -> None:
    """Let workers import this package from where the driver has it, as far as they see that folder. On a cluster that
    does not, the package is given to Spark as any other dependency (``--py-files``)."""
    root, worker = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in worker.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        worker["PYTHONPATH"] = os.pathsep.join([*known, root])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with at most ``limit`` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def remainder(column, divisor: int):
    """crc32 of the number as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


def neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but doc_id and text under names that clash with nothing, and what each column of
    ``docs`` is called then."""
    names = {c: c if c in ("doc_id", "text") else f"given{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def rows_numbered(docs: DataFrame) -> DataFrame:
    """Add ``_row``: a number by file path and place in the file, so that it is the same in every job, however the files
    are split. What is not just rows and columns picked from Parquet files is stored first."""
    plan = docs._jdf.queryExecution().analyzed()
    picked = plan.deterministic()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    place = None
    if picked and plan.nodeName() == "LogicalRelation":
        try:
            place = placed(docs)
        except AnalysisException:  # files or tables that do not number their rows
            pass
    if place is None:
        place = placed(stored(docs))
    # One row per file.
    files = sorted(r["_file"] for r in place.select("_file").distinct().collect())
    first = docs.sparkSession.createDataFrame([(f, i << 40) for i, f in enumerate(files)], "_file string, _first bigint")
    return place.join(F.broadcast(first), "_file").withColumn("_row", F.col("_first") + F.col("_at")).drop(
        "_file", "_at", "_first")


def placed(docs: DataFrame) -> DataFrame:
    where = docs.metadataColumn("_metadata")
    return docs.select("*", where["file_path"].alias("_file"), where["row_index"].alias("_at"))


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> tuple[DataFrame, int]:
    """Add ``name``: the sum of ``value`` over all rows before this one in ``order``, and return the grand total.

    Rows are range-sorted (``order`` must end with a unique column, so that equal keys spread over partitions), summed
    within partitions, and shifted by the sums of the partitions before: one number per partition is all that meets.
    """
    ranged = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    sums = ranged.groupBy("_part").agg(F.sum(value).cast("bigint").alias("_sum"))
    total = sums.agg(F.coalesce(F.sum("_sum"), F.lit(0))).first()[0]
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("bigint"))
    # One row per partition: the number of shuffle partitions bounds this broadcast.
    placed = placed.join(F.broadcast(shift), "_part")
    return placed.withColumn(name, F.col("_inside") + F.col("_shift")).drop("_inside", "_shift", "_part"), int(total)


def kept(docs: DataFrame, judge: Callable[[], Callable[[list[str | None]], list[bool]]]) -> DataFrame:
    """The rows of ``docs`` whose texts a worker's judge keeps, with all their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = judge()
        for part in pieces_of(batches, "text"):
            yield part.filter(pa.array(own(part.column("text").to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
