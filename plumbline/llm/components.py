"""Connected components of an edge list, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut_lineage


def signature(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for every node of ``edges`` (a, b: bigint) that is no root.

    A node's neighbours are only ever reduced to their least one, which combines before the shuffle; edges meet that
    one in a join whose other side has one row per node, so a node of very many edges is split by AQE.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges)
    before = signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut_lineage(small.unionByName(least.withColumnRenamed("m", "b")).distinct())
        after = signature(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
