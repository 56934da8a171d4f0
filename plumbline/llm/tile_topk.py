"""Exact top-k search by tiled matrix products (operator 8).

Query blocks meet vector shards in tiles. A tile is one matrix product; from each of its rows the ``k`` best are kept
by partial selection, and the short lists of a query are merged as a tree. Shards and blocks are dealt by a hash of the
row, so equal or similar vectors do not gather in one tile.

Rows: a vector that is null, or holds null or non-finite components, takes no part, nor does a row without an id; a
vector of another length than the query's takes no part in its list. Rows of one id are one row's copies: each counts
as a candidate unless its id is the query's own, and a repeated query id is searched once, with its smallest vector.
Scores beyond what a long holds are ranked exactly and reported as the largest (or smallest) long.
"""

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import table
from plumbline.llm.top_lists import merged

SHARD_ROWS, BLOCK_ROWS, STRIP = 16384, 2048, 256


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part: vec_id and ``vector`` (array of double)."""
    v = F.col(vector_col).cast("array<double>")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("vector")).where(
        fit & (F.size("vector") > 0))


def integers(matrix: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles where these hold it exactly, else as whole numbers of any size."""
    if np.abs(matrix).max(initial=0) * scale < 2.0 ** 53:
        return np.floor(scale * matrix)
    return np.frompyfunc(lambda x: int(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(scale * x), 1, 1)(matrix)


def bounded(score) -> int:
    return max(-(1 << 63) + 1, min((1 << 63) - 1, int(score)))


def tile(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """Positions (query, row) and scores of the k best rows of each query, ties to the smaller id."""
    exact = queries.dtype != object and rows.dtype != object and (
        np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1] < 2.0 ** 53)
    if not exact:  # beyond what doubles hold exactly: whole numbers of any size
        whole = np.frompyfunc(int, 1, 1)
        queries, rows = whole(queries), whole(rows)
    for start in range(0, len(queries), STRIP):
        part = slice(start, start + STRIP)
        scores = queries[part] @ rows.T
        for i, (own, line) in enumerate(zip(query_ids[part], scores), start):
            at = np.flatnonzero(row_ids != own)
            line = line[at]
            if len(at) > k:
                if exact:
                    least = -np.partition(-line, k - 1)[k - 1]
                else:
                    least = sorted(line, reverse=True)[k - 1]
                keep = np.flatnonzero((line >= least).astype(bool))
                at, line = at[keep], line[keep]
            order = sorted(range(len(at)), key=lambda j: (-line[j], row_ids[at[j]]))[:k]
            yield i, [int(row_ids[at[j]]) for j in order], [bounded(line[j]) for j in order]


def tile_lists(k: int, prepare: Callable[[np.ndarray], np.ndarray]):
    def run(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        lengths = right["vector"].str.len() if len(right) else None
        for size, queries in left.groupby(left["vector"].str.len()) if len(left) and len(right) else ():
            rows = right[lengths == size]
            if not len(rows):
                continue
            q = prepare(np.stack(queries["vector"].to_numpy()))
            r = prepare(np.stack(rows["vector"].to_numpy()))
            ids, part = queries["vec_id"].to_numpy(), int(rows["shard"].iloc[0])
            for i, found, scores in tile(q, ids, r, rows["vec_id"].to_numpy(), k):
                out.append((int(ids[i]), part, [{"order": -s, "vec_id": v} for s, v in zip(scores, found)]))
        return pd.DataFrame(out, columns=["query_id", "part", "top"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: each query's k best by the inner product of floor(scale * component)."""
    rows = usable(vectors, id_col, vector_col)
    asked = usable(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n, m = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-m // BLOCK_ROWS))
    # Whole numbers below 2**20 keep every tile even in size; the hash also spreads equal vectors.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int"))
    sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    lists = sent.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInPandas(
        tile_lists(k, lambda m_: integers(m_, scale)),
        "query_id bigint, part int, top array<struct<order:bigint,vec_id:bigint>>")
    best = merged(lists, k, shards).select("query_id", F.posexplode("top").alias("rank", "found"))
    return best.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("found.vec_id").alias("vec_id"),
                       (-F.col("found.order")).alias("score"))


def op8_tile_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


OP8_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
