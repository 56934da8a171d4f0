"""SimHash near-duplicates by a hierarchical index in Gray order (operator 6).

A fingerprint holds, per bit, whether more than half of a document's shingle hashes have it. Two fingerprints that
differ in at most two bits agree in one of three blocks of bits, so every fingerprint goes to three groups, one per
block value: the uppermost nodes, whose shared pattern is the block. Within a group fingerprints are sorted by Gray
rank; runs of neighbours form nodes that hold the bits common to all below them. A search descends from its group's
node, adds up the differences to the common bits, and leaves whole nodes out once they are more than two.

A group that is too large for a task is cut by the three blocks of its remaining bits, and so on; what is left after
three cuts has fewer than 20 free bits and so a bounded number of different fingerprints.

Rows: a null, empty or blank text has fingerprint zero and is linked like any other; repeated rows and ids share a
class; a null id is never the least of its class (a class of such rows only has a null id).
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import neutral, pieces_of, rows_numbered, table
from plumbline.llm.components import components
from plumbline.session import cut_lineage

WORDS, SEED, DISTANCE = 3, 42, 2
FAN, QUERIES, PAIRS, TASK_ROWS, GROUP_ROWS = 16, 4096, 1 << 16, 200_000, 100_000


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The signed 64-bit fingerprint of a text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    last = ends[min(words, len(tokens)) - 1:]
    digest = xxhash.xxh64_intdigest
    held = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 14):
        spans = zip(starts[i:min(n, i + (1 << 14))].tolist(), last[i:i + (1 << 14)].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype=">u8")
        held += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(held * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The key columns and ``fp`` (bigint) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces_of(batches, "text"):
            fps = pa.array([fingerprint(t) for t in part.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), fps], [*keys, "fp"])

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, "text").mapInArrow(run, f"{kinds}, fp bigint")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class GrayIndex:
    """Codes sorted by group and Gray rank, under nodes of at most FAN children that never cross a group."""

    def __init__(self, groups: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), groups))
        self.groups, self.codes = groups[order], codes[order]
        start = np.flatnonzero(np.r_[True, self.groups[1:] != self.groups[:-1]])
        self.group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(codes)]))
        group, low = self.group, self.codes
        high = self.codes
        self.levels = []  # from the leaves up: first child, past the last child, bits common below, their values
        while True:
            start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            within = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
            first = np.flatnonzero(within % FAN == 0)
            past = np.r_[first[1:], len(group)]
            both, any_ = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            self.levels.append((first, past, ~(both ^ any_), both))
            group, low, high = group[first], both, any_
            if len(first) == len(start):
                break

    def pairs(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of codes of one group that differ in at most ``distance`` bits, the first before the second."""
        for begin in range(0, len(self.codes), QUERIES):
            query = np.arange(begin, min(begin + QUERIES, len(self.codes)))
            waiting = [(len(self.levels) - 1, query, self.group[query])]
            while waiting:
                level, query, node = waiting.pop()
                if len(query) > PAIRS:
                    half = len(query) // 2
                    waiting += [(level, query[:half], node[:half]), (level, query[half:], node[half:])]
                    continue
                first, past, common, value = self.levels[level]
                near = bits((self.codes[query] ^ value[node]) & common[node]) <= distance
                query, node = query[near], node[near]
                width = past[node] - first[node]
                child = np.repeat(first[node] - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
                query = np.repeat(query, width)
                if level:
                    waiting.append((level - 1, query, child))
                    continue
                after = child > query
                query, child = query[after], child[after]
                same = bits(self.codes[query] ^ self.codes[child]) <= distance
                yield query[same], child[same]


def joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union by least position, for arrays of pairs."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def linked(distance: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        index = GrayIndex(pdf["grp"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64))
        parent = np.arange(len(pdf))
        for a, b in index.pairs(distance):
            parent = joined(parent, a, b)
        codes = index.codes.view(np.int64)
        child = np.flatnonzero(parent != np.arange(len(pdf)))
        return pd.DataFrame({"a": codes[child], "b": codes[parent[child]]})

    return run


def blocks_of(free, distance: int):
    """Three masks that part the bits of ``free`` evenly, as a column of arrays."""
    def masks(values: pd.Series) -> pd.Series:
        out = []
        for v in values:
            on = [i for i in range(64) if int(v) >> i & 1]
            cuts = [on[i * len(on) // (distance + 1):(i + 1) * len(on) // (distance + 1)] for i in range(distance + 1)]
            out.append([int(np.array(sum(1 << i for i in c), dtype=np.uint64).view(np.int64)) for c in cuts])
        return pd.Series(out)

    return F.pandas_udf(masks, "array<bigint>")(free)


def links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) that connect, within each group, the fingerprints (column fp, distinct) that are linked."""
    rows = codes.select("fp", F.lit(-1).cast("bigint").alias("free"), F.lit(0).cast("bigint").alias("grp"))
    found, depth = None, 0
    while True:
        free = rows.select("free").distinct().withColumn("mask", blocks_of(F.col("free"), distance))
        # A handful of patterns: one, then 3, then 9.
        rows = rows.join(F.broadcast(free), "free").select("fp", "free", "grp", F.explode("mask").alias("mask"))
        rows = rows.select(
            "fp", F.expr("free & ~mask").alias("free"),
            F.xxhash64("grp", "mask", F.expr("fp & mask")).alias("grp"))
        rows, depth = cut_lineage(rows), depth + 1
        sizes = rows.groupBy("grp").count()
        large = sizes.where(F.col("count") > GROUP_ROWS).select("grp")
        last = depth == 3 or large.isEmpty()
        small = rows if last else rows.join(large, "grp", "left_anti")
        n = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        tasks = F.lit(max(1, -(-n // TASK_ROWS), min(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                                     -(-n // 20_000))))
        edges = small.withColumn("task", F.pmod(F.col("grp"), tasks)).groupBy("task").applyInPandas(
            linked(distance), "a bigint, b bigint")
        found = edges if found is None else found.unionByName(edges)
        if last:
            return found
        rows = rows.join(large, "grp", "left_semi")


def classes(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), distance: int = DISTANCE) -> DataFrame:
    """The key columns, ``fp`` and ``root`` (the same for all rows of a class) of each row."""
    rows = cut_lineage(fingerprints(docs, keys))
    roots = components(links(rows.select("fp").distinct(), distance))
    named = roots.select(F.col("node").alias("fp"), "root")
    return rows.join(named, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (the least doc_id that is reachable) of each row."""
    rows = cut_lineage(classes(docs, distance=distance))
    least = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "root").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                           "component_id")


def one_of_each(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows that stay: of each class the one with the least doc_id (of equal ids, the first row by file and
    place), with all their columns, whatever these are called."""
    given, names = neutral(docs)
    numbered = rows_numbered(given)
    rows = classes(numbered, ("doc_id", "_row"), distance)
    keep = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("least"))
    left = numbered.join(keep.select(F.col("least._row").alias("_row")), "_row", "left_semi")
    return left.select(*(F.col(n).alias(c) for c, n in names.items()))


def op6_gray_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
