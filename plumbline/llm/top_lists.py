"""Merging of short ranked lists."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 16  # lists that one step of a merge holds together


def merged(lists: DataFrame, k: int, parts: int) -> DataFrame:
    """Merge lists (query_id, part, top: array of struct(order, vec_id, ...)) to one of ``k`` per query, as a tree:
    each step brings at most FAN_IN lists of at most ``k`` entries of a query together."""
    while True:
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("query_id", "part").agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            return lists.drop("part")
