"""Labelled documents: all of them, or bounded samples."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUPS = 16  # of partitions, each of which draws before the groups' draws meet
WORDS = 1 << 19  # of 64 bits each, in the field that tells labelled ids from most others


def drawn(ids: DataFrame, kind: str, bound: int) -> DataFrame:
    """Of each kind at most ``bound`` rows of ``ids`` (distinct in kind and doc_id): those of least hash of doc_id, so that
    the sample is the same in every run. Partitions draw, then groups of them, so the last task of a kind reads at most
    GROUPS times ``bound`` rows."""
    rank, ids = "_rank", ids.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    for keys in ([kind, "_group"], [kind]):
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= bound).drop(rank)
    return ids.drop("_group")


def one_text_each(rows: DataFrame, *keys: str) -> DataFrame:
    """The least text of each key: an id that is repeated brings one text, however many rows it has."""
    return rows.groupBy(*keys).agg(F.min("text").alias("text"))


def maybe(docs: DataFrame, known: DataFrame, words: int | None = None) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``known``, and few others: those whose hash has the place of a labelled one's
    in a field of bits. The field has ``words`` numbers at most, however many ids there are, and is broadcast, so that
    texts without a label are not shuffled. Ids of unlike types have unlike hashes, and all rows stay."""
    if docs.schema["doc_id"].dataType != known.schema["doc_id"].dataType:
        return docs
    place = F.xxhash64("doc_id")
    word, bit = F.pmod(F.shiftrightunsigned(place, 6), F.lit(words or WORDS)), F.expr("shiftleft(1L, CAST(xxhash64(doc_id) & 63 AS INT))")
    field = known.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return docs.withColumns({"_at": word, "_bit": bit}).join(
        F.broadcast(field), (F.col("_at") == F.col("_word")) & (F.col("_bits").bitwiseAND(F.col("_bit")) != 0), "left_semi").drop(
        "_at", "_bit")


def texts_of(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, _label and text of all labelled ids, one text an id."""
    rows = maybe(docs.select("doc_id", "text"), known).join(known, "doc_id")
    return one_text_each(rows, "doc_id", "_label")


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int):
    """doc_id, text and _label of at most ``bound`` labelled ids of each class, one text an id, and the number of
    labelled rows of both classes."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("_label")).distinct()
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    # At most twice ``bound`` ids.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn(known, "_label", bound)), "doc_id")
    return one_text_each(rows, "doc_id", "_label"), counts
