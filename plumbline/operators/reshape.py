"""Wide export to long entity-attribute-value table.

The wide table carries its file order in ``row_ord``. Nulls are kept only where a patient and element (or a
patient, episode and element) have no value at all, so true missingness stays visible.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed
from plumbline.functions.ordered import block_of, fill_forward, repeat_rows, running_count
from plumbline.functions.text import strip
from plumbline.session import stored

LONG_COLUMNS = ("PID", "Episode", "Episode_Date", "IX", "source_id", "source_value", "row_ord")
EPISODE_KEY = ["PID", "Episode", "Episode_Date", "source_id"]


def default_block(df: DataFrame) -> Column:
    """Block of ``row_ord``: the file split where the reader made it, else a fixed number of rows."""
    if df.schema["row_ord"].dataType.typeName() == "struct":
        return F.struct("row_ord.file", "row_ord.start")
    return block_of(F.col("row_ord"))


def clean_identifiers(wide: DataFrame, dictionary: DataFrame):
    """Canonical technical names, trimmed keys, lower-case form type."""
    wide = wide.withColumnsRenamed(fixed.RAW_EXPORT_RENAMES)
    keys = [c for c in ("PID", "Episode", "Episode_Date") if c in wide.columns]
    # A missing patient id becomes a group of its own, as text, and null again in the long table.
    wide = wide.withColumns({c: strip(F.coalesce(c, F.lit("nan"))) for c in keys})
    dictionary = dictionary.withColumns({
        "source_id": strip(F.col("source_id")), "form_type": F.lower(strip(F.col("form_type")))})
    return wide, dictionary


def value_columns(wide: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Dictionary ids by form type, each with a flag whether the export has the column."""
    return (
        dictionary.filter(F.col("form_type").isin("basic", "longitudinal") & F.col("source_id").isNotNull())
        .select("form_type", "source_id").distinct()
        .withColumn("in_export", F.col("source_id").isin([c for c in wide.columns]))
    )


def value_column_names(wide: DataFrame, dictionary: DataFrame):
    """Names of the present basic and longitudinal columns: at most the width of the export."""
    present = value_columns(wide, dictionary).filter("in_export").collect()
    by_type = {"basic": set(), "longitudinal": set()}
    for row in present:
        by_type[row.form_type].add(row.source_id)
    return tuple([c for c in wide.columns if c in by_type[t]] for t in ("basic", "longitudinal"))


def drop_test_locations(wide: DataFrame) -> DataFrame:
    """E3."""
    if "Location" not in wide.columns:
        return wide
    is_test = F.lower(strip(F.col("Location"))).contains(fixed.TEST_LOCATION_TEXT)
    return wide.filter(~F.coalesce(is_test, F.lit(False)))


def drop_no_data_rows(wide: DataFrame) -> DataFrame:
    """E4."""
    if fixed.UNIQUE_ID_COLUMN not in wide.columns:
        return wide
    marked = F.lower(strip(F.col(f"`{fixed.UNIQUE_ID_COLUMN}`"))) == fixed.NO_DATA_TEXT
    return wide.filter(~F.coalesce(marked, F.lit(False)))


def empty_to_null(df: DataFrame, columns) -> DataFrame:
    """E5."""
    missing = list(fixed.CELL_MISSING_TOKENS)
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(missing), F.col(f"`{c}`")) for c in present})


def fill_episode_context(wide: DataFrame, order=("row_ord",), block: Column = None) -> DataFrame:
    """Episode and episode date carried forward per patient, each on its own."""
    wide = empty_to_null(wide, ["Episode", "Episode_Date"])
    return fill_forward(wide, "PID", ["Episode", "Episode_Date"], list(order),
                        default_block(wide) if block is None else block)


def keep_rows_with_values(wide: DataFrame, source_ids) -> DataFrame:
    """Rows with at least one value. Every patient left has one, so no second pass is needed."""
    present = [c for c in source_ids if c in wide.columns]
    if not present:
        raise ValueError("none of the dictionary's source ids is a column of the export")
    wide = empty_to_null(wide, present)
    return wide.filter(F.coalesce(*[F.col(f"`{c}`") for c in present]).isNotNull())


def _cells(wide: DataFrame, keys, source_ids) -> DataFrame:
    kept = [c for c in ("row_ord", "_stage_block") if c in wide.columns]
    cells = wide.unpivot([*keys, *kept], list(source_ids), "source_id", "source_value")
    return cells.withColumn(
        "source_value", F.when(~F.col("source_value").isin("", " "), F.col("source_value")))


def basic_long(wide: DataFrame, source_ids) -> DataFrame:
    """One row per distinct value of a patient and element, one null row where there is none."""
    distinct = _cells(wide, ["PID"], source_ids).groupBy("PID", "source_id", "source_value").agg(
        F.min("row_ord").alias("row_ord"))
    missing = (
        distinct.groupBy("PID", "source_id")
        .agg(F.count("source_value").alias("_values"), F.min("row_ord").alias("row_ord"))
        .filter("_values = 0")
        .select("PID", "source_id", F.lit(None).cast("string").alias("source_value"), "row_ord")
    )
    return distinct.filter("source_value is not null").unionByName(missing).select(
        "PID",
        F.lit(fixed.BASIC_EPISODE).alias("Episode"),
        F.lit(None).cast("string").alias("Episode_Date"),
        F.lit("1").alias("IX"),
        "source_id", "source_value", "row_ord",
    )


def longitudinal_long(wide: DataFrame, source_ids, block: Column = None) -> DataFrame:
    """Values per patient, episode and element with a running index; duplicates are kept."""
    cells = _cells(wide.dropna(subset=["Episode", "Episode_Date"]), EPISODE_KEY[:3], source_ids)
    values = cells.filter("source_value is not null")
    values = running_count(values, EPISODE_KEY, ["row_ord", "source_value"],
                           default_block(values) if block is None else block, "IX")
    missing = cells.groupBy(*EPISODE_KEY).agg(
        F.count("source_value").alias("_values"), F.count("*").alias("_rows"),
        F.min("row_ord").alias("row_ord"),
    ).filter("_values = 0").drop("_values")
    missing = repeat_rows(missing, "_rows", "IX").withColumn("source_value", F.lit(None).cast("string"))
    return values.drop("_stage_block").unionByName(missing).withColumn("IX", F.col("IX").cast("string")).select(
        *LONG_COLUMNS)


def combine_long(*parts: DataFrame) -> DataFrame:
    """E11."""
    union = reduce(DataFrame.unionByName, [part.select(*LONG_COLUMNS) for part in parts])
    return union.withColumn("PID", F.nullif(F.col("PID"), F.lit("nan")))


def build_long(wide: DataFrame, dictionary: DataFrame, block: Column = None, stage: str = None) -> DataFrame:
    """E1-E11 in order: raw wide export to clean long export.

    The raw export is read twice, for the forward fill and for what that carries between blocks (two columns and the
    order). Its filled rows are then stored once, and everything else reads the few columns it needs of these. ``stage``
    names their folder, which may be dropped once the result is stored; by default it is a new shared one.
    """
    wide, dictionary = clean_identifiers(wide, dictionary)
    basic_ids, longitudinal_ids = value_column_names(wide, dictionary)
    wide = drop_no_data_rows(drop_test_locations(wide))
    keys = [c for c in EPISODE_KEY if c in wide.columns]
    wide = wide.select(*keys, *[F.col(f"`{c}`") for c in basic_ids + longitudinal_ids], "row_ord")
    block = default_block(wide) if block is None else block
    wide = keep_rows_with_values(fill_episode_context(wide, block=block), basic_ids + longitudinal_ids)
    wide = stored(wide.withColumn("_stage_block", block), stage)
    parts = []
    if basic_ids:
        parts.append(basic_long(wide, basic_ids))
    if longitudinal_ids:
        parts.append(longitudinal_long(wide, longitudinal_ids, F.col("_stage_block")))
    return combine_long(*parts)
