"""Readers. Every column is text; logical types come from the dictionary, not from the file."""

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from plumbline import fixed_values as fixed
from plumbline.functions.text import normalise_nulls

FIRST_ROW_COUNTS = ("date_rules", "report_metadata")
EXPORT_COLUMNS = ("PID", "Episode", "Episode_Date", "IX", "source_id", "source_value")


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def file_order() -> Column:
    """Position of a row in its input, taken at the scan: file, split start, running number in the task."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"),
    )


def read_text_table(spark: SparkSession, path: str, columns, sep: str = ";", multiline: bool = False) -> DataFrame:
    """Delimited file with a header, as text with missing tokens as null and ``row_ord``.

    Columns are found by name, so a file may have more of them or another order. A byte-order mark is skipped.
    ``multiline`` reads texts that hold line breaks, at the price of one task per file: for metadata only.
    """
    header = spark.read.option("sep", sep).option("header", True).csv(path).columns
    names = [h.lstrip("﻿").strip() for h in header]
    absent = [c for c in columns if c not in names]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    rows = (
        spark.read.option("sep", sep).option("header", True).option("enforceSchema", True)
        .option("multiLine", multiline)
        .option("escape", '"').schema(text_schema(names)).csv(path)
        .select(*[F.col(f"`{c}`") for c in columns], file_order().alias("row_ord"))
    )
    return normalise_nulls(rows, list(columns))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text with their place: ``value``, ``row_ord``, and ``_line``, counted from 0 in a file's first split."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_block_start").alias("_start"), file_order().alias("row_ord"))
    begins = lines.filter("_start = 0").groupBy(F.col("row_ord.file").alias("_file")).agg(
        F.min("row_ord.n").alias("_first"))
    return lines.join(begins, F.col("row_ord.file") == F.col("_file")).withColumn(
        "_line", F.when(F.col("_start") == 0, F.col("row_ord.n") - F.col("_first"))).select("value", "row_ord", "_line")


def _inside_after(text: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted cell, if it starts outside one and if it starts inside one.

    Doubled quotes change neither answer. Of the other quotes only one at the start of a cell opens it; in the middle of
    a cell that is not quoted a quote is a character like others.
    """
    border, other = rf"(^|\Q{sep}\E)", rf"[^\Q{sep}\E]"
    single = F.replace(text, F.lit('""'), F.lit(""))
    opened = lambda t: F.regexp_replace(t, rf'{border}"[^"]*+"', "$1").rlike(rf'{border}"')
    rest = F.regexp_replace(single, rf'^[^"]*+"{other}*+', "")
    return opened(single), F.when(~single.contains('"'), F.lit(True)).otherwise(opened(rest))


def records(lines: DataFrame, sep: str, preamble: int = 0) -> DataFrame:
    """Lines as records: lines within which a quoted cell goes on are joined, by a line feed, also across splits.

    Each line maps the state before it (outside or inside a quoted cell) to the one after it. Such a map sets the state,
    keeps it or turns it, so the state follows from the last line that sets it and the number of turns since. That runs
    within each split; one row per split carries it, and the place of the record still open, to the splits behind. Only
    records of several lines are grouped. A quoted cell that never ends stops the job, as its file cannot be read.
    The first ``preamble`` lines of a file are free text.
    """
    free = F.coalesce(F.col("_line") < preamble, F.lit(False))
    after_outside, after_inside = _inside_after(F.col("value"), sep)
    outside, inside = [F.when(free, F.lit(False)).otherwise(c) for c in (after_outside, after_inside)]
    split = [F.col("row_ord.file"), F.col("row_ord.start")]
    in_split = W.partitionBy(*split).orderBy("row_ord.n")
    upto = in_split.rowsBetween(W.unboundedPreceding, W.currentRow)
    odd = lambda n: F.pmod(n, F.lit(2)).cast("int")
    moved = (
        lines.withColumns({"_o": outside.cast("int"), "_i": inside.cast("int")})
        .withColumn("_turns", F.sum(F.when(F.col("_o") > F.col("_i"), 1).otherwise(0)).over(upto))
        # What the last setting line set, less the turns before it, so that all turns can be added.
        .withColumn("_set", F.last(F.when(F.col("_o") == F.col("_i"), odd(F.col("_o") + F.col("_turns"))),
                                   ignorenulls=True).over(upto))
        .withColumns({"_set_before": F.lag("_set").over(in_split),
                      "_turns_before": F.lag("_turns", 1, 0).over(in_split)})
    )
    before = lambda start: odd(F.coalesce("_set_before", start) + F.col("_turns_before"))
    n = F.col("row_ord.n")
    splits = moved.groupBy(split[0].alias("_file"), split[1].alias("_start")).agg(
        F.max_by("_turns", n).alias("_turns"), F.max_by("_set", n).alias("_set"),
        *[F.max(F.when(before(F.lit(s)) == 0, n)).alias(f"_last_{s}") for s in (0, 1)])
    in_file = W.partitionBy("_file").orderBy("_start")
    so_far = in_file.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    splits = (
        splits.withColumn("_all", F.sum("_turns").over(so_far))
        .withColumn("_held", F.last(F.when(F.col("_set").isNotNull(), odd(F.col("_set") + F.col("_turns") + F.col("_all"))),
                                    ignorenulls=True).over(so_far))
        .withColumn("_after", odd(F.coalesce("_held", F.lit(0)) + F.col("_all")))
        .withColumn("_state", F.lag("_after", 1, 0).over(in_file))
        .withColumn("_last", F.when(F.col("_state") == 0, F.col("_last_0")).otherwise(F.col("_last_1")))
        .withColumn("_open", F.last(F.when(F.col("_last").isNotNull(), F.struct(F.col("_start").alias("start"), F.col(
            "_last").alias("n"))), ignorenulls=True).over(earlier))
        .withColumn("_unended", F.last("_after").over(W.partitionBy("_file").orderBy("_start").rowsBetween(
            W.unboundedPreceding, W.unboundedFollowing)) == 1)
        .select("_file", "_start", "_state", "_open", "_unended")
    )
    fail = F.raise_error(F.concat(F.lit("a quoted cell never ends in "), F.col("_file")))
    placed = moved.join(splits, (split[0] == F.col("_file")) & (split[1] == F.col("_start")))
    placed = placed.withColumn("_before", F.when(F.col("_unended"), fail.cast("int")).otherwise(before(F.col("_state"))))
    at = F.struct(F.col("row_ord.start").alias("start"), n.alias("n"))
    placed = placed.withColumn("_record", F.coalesce(
        F.last(F.when(F.col("_before") == 0, at), ignorenulls=True).over(upto), "_open"))
    alone = (F.col("_before") == 0) & (F.col("_o") == 0)
    first = lambda c: F.min_by(c, at)
    several = placed.filter(~alone).groupBy("_file", "_record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at.alias("at"), "value"))),
                                 lambda x: x["value"]), "\n").alias("value"),
        first("row_ord").alias("row_ord"), first("_line").alias("_line"))
    return placed.filter(alone).select("value", "row_ord", "_line").unionByName(several.select("value", "row_ord", "_line"))


def _header(rows: DataFrame, path: str, line: int, sep: str) -> list[str]:
    """Names in the header record of every file, which must be the same."""
    heads = rows.filter(F.col("_line") == line).select(
        F.regexp_replace("value", "^\ufeff", "").alias("value")).distinct().take(2)
    if len(heads) != 1:
        raise ValueError(f"{path} has {'no header' if not heads else 'files with different headers'}")
    names = next(csv.reader(io.StringIO(heads[0].value), delimiter=sep, skipinitialspace=True))
    return [n.strip() for n in names]


def _parsed(rows: DataFrame, names: list[str], line: int, sep: str) -> DataFrame:
    """Records behind the header as columns; empty lines are no records."""
    body = rows.filter((F.col("_line").isNull() | (F.col("_line") > line)) & (F.col("value") != ""))
    fields = F.from_csv("value", F.lit(_ddl(names)), {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    return body.select(fields.alias("_row"), "row_ord").select("_row.*", "row_ord")


def read_long_export(spark: SparkSession, path: str) -> DataFrame:
    """Clean long export, from parquet written by :mod:`plumbline.sources.writers` or from text files with a header,
    whose cells may hold line breaks."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    rows = records(_lines(spark, path), ";")
    names = _header(rows, path, 0, ";")
    absent = [c for c in EXPORT_COLUMNS if c not in names]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    return normalise_nulls(_parsed(rows, names, 0, ";").select(*EXPORT_COLUMNS, "row_ord"), list(EXPORT_COLUMNS))


def read_wide_export(spark: SparkSession, path: str) -> DataFrame:
    """Raw wide export below its preamble lines, header names trimmed, missing tokens as null.

    Cells may hold line breaks. The preamble is told by its place at the start of each file, so a record that equals one
    of its lines stays; it must lie in the file's first split. Several files must have one header.
    """
    first = fixed.RAW_EXPORT_PREAMBLE_LINES
    rows = records(_lines(spark, path), ";", first)
    names = _header(rows, path, first, ";")
    return normalise_nulls(_parsed(rows, names, first, ";"), names)


def _ddl(names) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)


def read_element_list(spark: SparkSession, path: str) -> DataFrame:
    """S3: the fifteen named columns of the element list."""
    return read_text_table(spark, path, list(fixed.ELEMENT_LIST_RENAMES), sep=",", multiline=True)


def read_rule_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the rule tables, by the name it has in ``RULE_TABLE_COLUMNS``. Where the first of several rows counts,
    the table keeps its order in ``row_ord``."""
    rows = read_text_table(spark, path, fixed.RULE_TABLE_COLUMNS[name], multiline=True)
    return rows if name in FIRST_ROW_COUNTS else rows.drop("row_ord")


def read_table(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Any other delimited table, such as the dictionary, the codebook or patient-form versions."""
    header = spark.read.option("sep", sep).option("header", True).csv(path).columns
    return read_text_table(spark, path, [h.lstrip("﻿").strip() for h in header], sep, multiline=True)
