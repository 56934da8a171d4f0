"""Hard-negative mining by segment summary filtering (operator 11).

A vector's components are whole numbers, floor(scale * x). Each vector is stored with the mean and the deviation (length
of what is left when the mean is taken off) of its segments, at several levels, a level's segments being cut in four for
the next. On a segment of w components the product of two vectors is w times the product of their means, give or take at
most the product of their deviations; summed over segments this bounds the score. A tile (block of anchors, shard of
rows) starts with one segment, drops the rows whose bounds cannot matter, refines the segments of the others and scores
what is left exactly, so results do not depend on the bounds.

Two rounds: an anchor's positives are its best rows of the same label; then, the positives' scores being known, each
positive's negatives are the best rows of another label within a band of its score. Both rounds end in the tree merge
of short lists that exact search uses. Rows are dealt to shards by a hash of id and vector, anchors to blocks of up to
BLOCK_ROWS by a hash of their id: a row is copied once for each block, equal vectors and hot labels spread evenly.

Rows: a row whose id, label or vector is null, or whose vector is empty or holds null or non-finite components, takes no
part; a vector takes part only for anchors of its length. Rows of one id are copies of one row: none of them is its own
anchor's candidate, each counts for others, and a repeated anchor id is searched once, with its smallest label and
vector. Equal rows are counted before they are dealt and only as many kept as a list can hold, which changes no result.
Ties go to smaller ids. Texts are not looked at, nor are other columns; an empty table gives no rows. Scores beyond what
a long holds are ranked exactly and reported as the largest (or smallest) long, and a positive's band follows from the
score as reported.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import table
from plumbline.llm.tile_topk import bounded, integers
from plumbline.llm.top_lists import merged
from plumbline.session import stored

SHARD_ROWS, BLOCK_ROWS, STRIP, MOST_TASKS = 8192, 32768, 128, 20000
LEVELS = (1, 4, 16)  # segments of a level
EXACT = 2.0 ** 53
PACKED = "length int, ids binary, labels binary, vectors binary"


def participants(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """vec_id, label and vector (array of double) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fit = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"),
                          v.alias("vector"))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(
        fit & (F.size("vector") > 0))


def segments(matrix: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, means and deviations of ``n`` segments of each row."""
    edges = np.arange(n + 1) * matrix.shape[1] // n
    width = np.diff(edges)
    with np.errstate(over="ignore", invalid="ignore"):
        mean = np.add.reduceat(matrix, edges[:-1], axis=1) / width
        rest = matrix - np.repeat(mean, width, axis=1)
        return width, mean, np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))


def levels(length: int) -> list[int]:
    return [n for n in LEVELS if n < length]


def summaries(matrix: np.ndarray) -> np.ndarray:
    """Means and deviations of all levels side by side, one line per row."""
    found = [np.hstack(segments(matrix, n)[1:]) for n in levels(matrix.shape[1])]
    return np.hstack(found) if found else np.zeros((len(matrix), 0))


def packed(scale: int):
    """Rows of one group as one row of arrays, with the summaries."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["label", "vec_id"], kind="stable")
        raw = np.stack(rows["vector"].to_numpy()).astype("<f8")
        whole = integers(raw, scale).astype("<f8")
        first = {c: [rows[c].iloc[0]] for c in rows.columns if c in ("shard", "block")}
        arrays = {"ids": rows["vec_id"].to_numpy("<i8"), "labels": rows["label"].to_numpy("<i8"), "vectors": raw,
                  "summary": summaries(whole).astype("<f8")}
        if "top" in rows:
            k = max(map(len, rows["top"]))
            lists = [[(x["order"], x["vec_id"]) for x in t] + [(0, 0)] * (k - len(t)) for t in rows["top"]]
            arrays |= {"counts": np.array([len(t) for t in rows["top"]], "<i8"), "tops": np.array(lists, "<i8")}
        return pd.DataFrame(first | {"length": [raw.shape[1]]} | {c: [a.tobytes()] for c, a in arrays.items()})

    return run


class Rows:
    """A packed group as arrays; ``whole`` holds doubles where these are exact, else whole numbers of any size."""

    def __init__(self, row, scale: int):
        self.ids, self.labels = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.labels, "<i8")
        self.whole = integers(np.frombuffer(row.vectors, "<f8").reshape(len(self.ids), -1), scale)
        self.summary = np.frombuffer(row.summary, "<f8").reshape(len(self.ids), -1)
        self.most = np.abs(self.whole).max(initial=0)

    def level(self, i: int, part=slice(None)) -> tuple[np.ndarray, np.ndarray]:
        sizes = levels(self.whole.shape[1])
        at = 2 * sum(sizes[:i])
        return self.summary[part, at:at + sizes[i]], self.summary[part, at + sizes[i]:at + 2 * sizes[i]]


def exact(asked: Rows, rows: Rows) -> bool:
    """Whether doubles hold all scores, and all sums on the way to them, exactly."""
    if asked.whole.dtype == object or rows.whole.dtype == object:
        return False
    return asked.most * rows.most * asked.whole.shape[1] < EXACT


def bounds(asked: Rows, part: slice, rows: Rows, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible scores of a strip of anchors and all rows by the segments of level ``i``."""
    n = levels(asked.whole.shape[1])[i]
    width = np.diff(np.arange(n + 1) * asked.whole.shape[1] // n)
    (m, d), (mean, deviation) = asked.level(i, part), rows.level(i)
    middle, reach = (m * width) @ mean.T, d @ deviation.T
    reach += 1e-10 * asked.most * rows.most * asked.whole.shape[1] + 1e-6  # rounding
    return middle - reach, middle + reach


def kth(values: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest allowed value of each line, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return -np.partition(np.where(allowed, -values, np.inf), k - 1, axis=1)[:, k - 1]


def scores_of(asked: Rows, part: slice, rows: Rows, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns that are left for any anchor of the strip and their exact scores."""
    at = np.flatnonzero(left.any(0))
    if exact(asked, rows):
        return at, asked.whole[part] @ rows.whole[at].T
    whole = np.frompyfunc(int, 1, 1)
    return at, whole(asked.whole[part]).astype(object) @ whole(rows.whole[at]).astype(object).T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[dict]:
    """The k highest scores, ties to smaller ids, as entries of a list to merge."""
    if len(ids) > k and scores.dtype != object:
        keep = np.flatnonzero(scores >= -np.partition(-scores, k - 1)[k - 1])
        scores, ids = scores[keep], ids[keep]
    if scores.dtype == object:
        order = sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k]
    else:
        order = np.lexsort((ids, -scores))[:k]
    return [{"order": -bounded(scores[j]), "vec_id": int(ids[j])} for j in order]


def positives_in(asked: Rows, rows: Rows, k: int):
    """Anchor place and list of its k best rows of the same label in this shard."""
    for start in range(0, len(asked.ids), STRIP):
        part = slice(start, start + STRIP)
        left = (asked.labels[part, None] == rows.labels) & (asked.ids[part, None] != rows.ids)
        if exact(asked, rows):
            for i in range(len(levels(asked.whole.shape[1]))):
                low, high = bounds(asked, part, rows, i)
                left &= high >= kth(low, left, k)[:, None]
        at, scores = scores_of(asked, part, rows, left)
        for j, line in enumerate(left[:, at]):
            keep = np.flatnonzero(line)
            if len(keep):
                yield start + j, best(scores[j, keep], rows.ids[at[keep]], k)


def negatives_in(asked: Rows, bands: list[list[tuple[int, int]]], rows: Rows, k: int):
    """Anchor place, number of its band and list of the k best rows of another label in the band in this shard."""
    most = max(map(len, bands), default=0)
    none = (np.inf, -np.inf)
    for start in range(0, len(asked.ids), STRIP):
        part = slice(start, start + STRIP)
        left = (asked.labels[part, None] != rows.labels) & (asked.ids[part, None] != rows.ids)
        own = bands[part]
        if exact(asked, rows):
            limits = np.array([[*b, *[none] * (most - len(b))] for b in own], float).reshape(len(own), most, 2)
            for i in range(len(levels(asked.whole.shape[1]))):
                low, high = bounds(asked, part, rows, i)
                wanted = np.zeros_like(left)
                for b in range(most):
                    least, greatest = limits[:, b, 0, None], limits[:, b, 1, None]
                    surely = left & (low >= least) & (high <= greatest)
                    if surely.any():  # what is surely in the band pushes out what surely scores less
                        least = np.maximum(least, kth(low, surely, k)[:, None])
                    wanted |= (high >= least) & (low <= greatest)
                left &= wanted
        at, scores = scores_of(asked, part, rows, left)
        for j, line in enumerate(left[:, at]):
            keep = np.flatnonzero(line)
            held, ids = scores[j, keep], rows.ids[at[keep]]
            for b, (least, greatest) in enumerate(own[j]):
                inside = np.flatnonzero(((held >= least) & (held <= greatest)).astype(bool))
                if len(inside):
                    yield start + j, b, best(held[inside], ids[inside], k)


def band(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def tiled(asked: DataFrame, index: DataFrame, blocks: int, shards: int):
    """Every block with every shard, one pair of rows to a group, dealt evenly to as many tasks as there are pairs."""
    keys, tasks = ["length", "block", "shard"], min(blocks * shards, MOST_TASKS)
    sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(tasks, *keys)
    dealt = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, *keys)
    return sent.groupBy(*keys).cogroup(dealt.groupBy(*keys))


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, scale: int = 256, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each anchor and each of its
    ``positives`` best rows of the same label the ``negatives`` best rows of another label whose score lies between
    ``low`` and ``high`` percent of the positive's."""
    rows = participants(vectors, id_col, label_col, vector_col).groupBy("vec_id", "label", "vector").agg(
        F.count("*").alias("n"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(max(positives, negatives))))))
    asked = participants(anchors, id_col, label_col, vector_col).groupBy("vec_id").agg(
        F.min(F.struct("label", "vector")).alias("_row")).select("vec_id", "_row.*")
    n, m = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-m // BLOCK_ROWS))
    summary = "summary binary"
    shard = F.pmod(F.xxhash64("vec_id", "vector", "copy", F.lit(1)), F.lit(shards)).cast("int")
    index = stored(rows.select("vec_id", "label", "vector", F.size("vector").alias("length"), shard.alias("shard"))
                   .groupBy("length", "shard").applyInPandas(packed(scale), f"shard int, {PACKED}, {summary}"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int")
    asked = asked.select("vec_id", "label", "vector", F.size("vector").alias("length"), block.alias("block"))
    first = asked.groupBy("length", "block").applyInPandas(packed(scale), f"block int, {PACKED}, {summary}")

    def find_positives(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a in left.itertuples():
            for r in right.itertuples():
                own, others = Rows(a, scale), Rows(r, scale)
                out += [(int(own.ids[i]), r.shard, found) for i, found in positives_in(own, others, positives)]
        return pd.DataFrame(out, columns=["query_id", "part", "top"])

    lists = tiled(first, index, blocks, shards).applyInPandas(
        find_positives, "query_id bigint, part int, top array<struct<order:bigint,vec_id:bigint>>")
    found = merged(lists, positives, shards).withColumnRenamed("query_id", "vec_id")
    second = stored(asked.join(found, "vec_id").groupBy("length", "block").applyInPandas(
        packed(scale), f"block int, {PACKED}, {summary}, counts binary, tops binary"))

    def find_negatives(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a in left.itertuples():
            counts = np.frombuffer(a.counts, "<i8")
            tops = np.frombuffer(a.tops, "<i8").reshape(len(counts), -1, 2).tolist()
            bands = [[band(-order, low, high) for order, _ in t[:c]] for t, c in zip(tops, counts.tolist())]
            for r in right.itertuples():
                own, others = Rows(a, scale), Rows(r, scale)
                for i, b, top in negatives_in(own, bands, others, negatives):
                    key = {"anchor_id": int(own.ids[i]), "place": b, "positive_id": tops[i][b][1],
                           "positive_score": -tops[i][b][0]}
                    out.append((key, r.shard, top))
        return pd.DataFrame(out, columns=["query_id", "part", "top"])

    lists = tiled(second, index, blocks, shards).applyInPandas(
        find_negatives, "query_id struct<anchor_id:bigint,place:int,positive_id:bigint,positive_score:bigint>, "
                        "part int, top array<struct<order:bigint,vec_id:bigint>>")
    last = merged(lists, negatives, shards).select("query_id", F.posexplode("top").alias("rank", "found"))
    return last.select("query_id.anchor_id", "query_id.positive_id", (F.col("rank") + 1).cast("int").alias("rank"),
                       F.col("found.vec_id").alias("negative_id"), "query_id.positive_score",
                       (-F.col("found.order")).alias("negative_score"))


def op11_segment_negatives(spark, sf_dir: str) -> DataFrame:
    """Negatives of every vector whose id is divisible by 50; ids divisible by 7 carry the next label."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same
), r AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
         s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM r WHERE rank <= 3
"""
