"""Approximate nearest neighbours by a forest of hash prefixes (operator 2).

Every tree gives a vector a long string of bits, the signs of its products with random directions. A tree is the array
of these strings in order; the vectors that share a prefix with a query are a range of it. A search descends in all
trees to the longest common prefixes and then ascends in all of them at once, one bit at a time, until enough different
candidates are met, whose cosines are then taken exactly.

Vectors are dealt to shards by a hash of the id, each shard is a forest of its own that fits a worker, every query
visits every shard and the short lists are merged: nothing depends on how alike vectors are, and a third of all vectors
being equal makes no shard larger. The candidates to meet in a shard are a share of its rows (``share``), since the
distance to a near neighbour, hence the prefix length that finds it, does not depend on the number of rows.

Rows: a vector that is null, zero, or holds null or non-finite components takes no part, nor does a row without an id;
a vector of another length than the query's is no candidate for it. A repeated query id is searched once, with its
smallest vector. Ties go to the smaller id.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import table
from plumbline.llm.tile_topk import usable
from plumbline.llm.top_lists import merged

TREES, BITS, SHARE, SEED = 64, 24, 0.4, 11
SHARD_ROWS, BLOCK_ROWS = 16384, 1024


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        self.bits, self.trees = bits, trees
        self.across = [rng.normal(size=(vectors.shape[1], bits)) for _ in range(trees)]
        self.weight = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        strings = self.strings(vectors)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([(vectors @ a > 0) @ self.weight for a in self.across])

    def search(self, queries: np.ndarray, wanted: int):
        """Candidates of each query, as positions: the rows met when ``wanted`` different ones (or all) were met."""
        strings = self.strings(queries)
        n = self.order.shape[1]
        low = np.zeros((self.bits + 1, self.trees, len(queries)), dtype=np.int64)
        high = np.full_like(low, n)
        for depth in range(1, self.bits + 1):
            prefix = strings >> (self.bits - depth) << (self.bits - depth)
            for t in range(self.trees):
                low[depth, t] = np.searchsorted(self.sorted[t], prefix[t], "left")
                high[depth, t] = np.searchsorted(self.sorted[t], prefix[t] + (1 << (self.bits - depth)), "left")
        sizes = (high - low).sum(1)
        for q in range(len(queries)):
            enough = np.flatnonzero(sizes[:, q] >= wanted)
            met = np.zeros(n, dtype=bool)
            for depth in range(int(enough[-1]) if len(enough) else 0, -1, -1):
                for t in range(self.trees):
                    met[self.order[t, low[depth, t, q]:high[depth, t, q]]] = True
                if depth == 0 or np.count_nonzero(met) >= wanted:
                    break
            yield np.flatnonzero(met)


def shard_lists(k: int, trees: int, bits: int, share: float, seed: int):
    def run(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        lengths = right["vector"].str.len() if len(right) else None
        for size, queries in left.groupby(left["vector"].str.len()) if len(left) and len(right) else ():
            rows = right[lengths == size]
            if not len(rows):
                continue
            q, r = np.stack(queries["vector"].to_numpy()), np.stack(rows["vector"].to_numpy())
            # Scale first, so that squares of very large or small components neither overflow nor vanish.
            q, r = q / np.abs(q).max(1, keepdims=True), r / np.abs(r).max(1, keepdims=True)
            q, r = q / np.linalg.norm(q, axis=1, keepdims=True), r / np.linalg.norm(r, axis=1, keepdims=True)
            ids, part = rows["vec_id"].to_numpy(), int(rows["shard"].iloc[0])
            forest = Forest(r, trees, bits, seed)
            for own, vector, met in zip(queries["vec_id"].tolist(), q, forest.search(q, max(k + 1, int(share * len(r))))):
                met = met[ids[met] != own]
                near = r[met] @ vector
                if len(met) > k:
                    keep = np.flatnonzero(near >= np.partition(near, len(near) - k)[len(near) - k] - 1e-12)
                    met, near = met[keep], near[keep]
                near = np.array([float(np.dot(r[m], vector)) for m in met])
                order = np.lexsort((ids[met], -near))[:k]
                out.append((own, part, [{"order": -near[j], "vec_id": int(ids[met[j]])} for j in order]))
        return pd.DataFrame(out, columns=["query_id", "part", "top"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, bits: int = BITS,
            share: float = SHARE, seed: int = SEED, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (cosine): each query's k nearest among the candidates that the forest finds."""
    not_zero = F.exists("vector", lambda x: x != 0)
    rows = usable(vectors, id_col, vector_col).where(not_zero)
    asked = usable(queries, id_col, vector_col).where(not_zero).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n, m = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-m // BLOCK_ROWS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int"))
    sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    lists = sent.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInPandas(
        shard_lists(k, trees, bits, share, seed),
        "query_id bigint, part int, top array<struct<order:double,vec_id:bigint>>")
    best = merged(lists, k, shards).select("query_id", F.posexplode("top").alias("rank", "found"))
    return best.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("found.vec_id").alias("vec_id"),
                       (-F.col("found.order")).alias("score"))


def op2_prefix_forest(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))
