"""A corpus pipeline of the operators in plumbline.llm: each stage works on all that the one before it kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import fm_dedup, gray_simhash, language_crf, noisy_toxicity, packing
from plumbline.llm.common import kept, reachable, remainder, table
from plumbline.session import stored

LEAST_LANGUAGE = 0.4  # mean probability of a document's language below which no language holds most of it
TOXIC = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or without a language that its words agree on, go. If nothing is
    labelled with a language, none can be identified and all documents stay."""
    model = language_crf.learn(docs)
    if model is None:
        return docs

    def judge():
        tagger = language_crf.Tagger(model)
        return lambda texts: [bool(len(c)) and bool(c.mean(0).max() >= LEAST_LANGUAGE) for c in tagger.chances(texts)]

    return kept(docs, judge)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that score TOXIC or more go."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    model = noisy_toxicity.learn(docs, labels)
    if model is None:
        return docs

    def judge():
        score = noisy_toxicity.scorer(model)
        return lambda texts: [score(t) < TOXIC for t in texts]

    return kept(docs, judge)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of linked documents the one with the least doc_id stays."""
    return gray_simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: words of repeated passages go; a text that loses none stays as it is, all rows stay."""
    text = F.col("kept").cast("string")
    columns = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("row.n_chars"))}
    rows = fm_dedup.removed(docs)
    return rows.select(*(columns.get(c, F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c)
                         for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of sequences that the documents left are cut into."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language), ("toxicity", toxicity), ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup), ("packing", pack),
]
ORACLE_SQL = None  # models and Hilbert order are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
