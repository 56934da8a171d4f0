"""Alignment of two tokenizers' tokens over exact-text groups (operator 12).

Documents are shuffled by their full text and counted, and each distinct text is tokenised and aligned once. Both
tokenizers cut the same bytes (a space and the text), so their tokens are laid side by side: where a token of A and one
of B end at the same byte, a group of tokens ends and these two are linked. How often a pair of ids is linked in the
corpus is the number of its links in each distinct text times the text's copies. The measures of a text are joined to
all its documents by the text's SHA-256.

Which id pairs can ever be linked follows from the vocabularies alone: tokens that end together are equal, or one is the
other's ending. These pairs (324,297 for the default files, at most one per ending of a token) are numbered, so the
corpus-wide counts are one array of that length, whatever the corpus; this is what is summed, gathered and broadcast.
A text's links are stored as these numbers, not tokenised again.

Hot texts: the shuffle by text counts copies before it; texts with more than one in HOT of the documents (fewer than HOT
of them) are joined by broadcast and the others by shuffle, so no task gets a hot text's documents. Documents without
tokens are not shuffled.

Rows: texts that are null, empty, or that the tokens of A or B do not spell byte by byte have no tokens: zeros and empty
groups. Special tokens in texts are plain text. Repeated rows give a row each, a null id stays null. Texts are aligned
whole, however long; a worker holds one block of texts (4 MB, or one longer text) and its tokens. An empty table gives
no rows; columns other than id and text are not looked at, whatever their names.
"""

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pieces_of, table
from plumbline.llm.packing import tokens_of
from plumbline.session import new_folder

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
HOT = 1000


class Pieces:
    """A sentence-piece model's ids, and each piece's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = [self.bytes_of(i) for i in range(self.model.get_piece_size())]

    def bytes_of(self, id_: int) -> bytes:
        piece = self.model.id_to_piece(id_)
        if self.model.is_byte(id_):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()


class Aligner:
    """Tokens of both files, the pairs that can be linked, and the alignment of one text."""

    def __init__(self, a: str, b: str):
        self.a, self.b = tokens_of(a), Pieces(b)
        left = {id_: raw for raw, id_ in self.a.ranks.items()}
        right = {i: raw for i, raw in enumerate(self.b.spelled) if not self.b.model.is_control(i)}
        self.size = len(self.b.spelled)
        self.sizes_a = np.zeros(max(left) + 1, np.int64)
        self.sizes_a[list(left)] = [len(x) for x in left.values()]
        self.sizes_b = np.array([len(x) for x in self.b.spelled], np.int64)
        self.pairs = np.unique(np.array([*endings(left, right, self.size), *endings(right, left, self.size, True)],
                                        np.int64))
        self.of_b = self.pairs % self.size
        # An id's digits and the mark behind it, in one cell; unused bytes of a cell are taken out afterwards.
        width = len(str(max(len(self.sizes_a), self.size))) + 1
        self.digits = {m: np.array([f"{i}{m}" for i in range(max(len(self.sizes_a), self.size))], f"S{width}")
                       for m in ",|;"}

    def align(self, text: str) -> tuple[int, int, bytes, np.ndarray]:
        """Numbers of A's and B's tokens, groups as text, and the pairs linked; none if the tokens spell another text."""
        raw = (" " + text).encode()
        a = self.a.plain(" " + text).astype(np.int64)
        b = np.array(self.b.model.encode(text), np.int64)
        spelled = self.b.spelled
        if self.a.fast.decode_bytes(a.tolist()) != raw or b"".join([spelled[i] for i in b.tolist()]) != raw:
            return 0, 0, b"", np.zeros(0, np.uint32)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        mark = np.zeros(len(raw) + 1, bool)
        mark[ends_b] = True
        last_a = mark[ends_a]
        mark[:] = False
        mark[ends_a] = True
        last_b = mark[ends_b]
        linked = np.searchsorted(self.pairs, a[last_a] * self.size + b[last_b]).astype(np.uint32)
        return len(a), len(b), self.groups(a, b, last_a, last_b), linked

    def groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        at_a, at_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_a, before_b = np.concatenate([at_a, [len(a)]]), np.concatenate([[0], at_b])
        cells = np.empty(len(a) + len(b), self.digits[","].dtype)
        cells[np.arange(len(a)) + before_b[group_a]] = np.where(last_a, self.digits["|"][a], self.digits[","][a])
        cells[np.arange(len(b)) + before_a[group_b]] = np.where(last_b, self.digits[";"][b], self.digits[","][b])
        return cells.tobytes().replace(b"\0", b"")[:-1]


def endings(whole: dict[int, bytes], parts: dict[int, bytes], size: int, turned: bool = False) -> list[int]:
    """Numbers of pairs of a token of ``whole`` and a token of ``parts`` that it ends with."""
    ids: dict[bytes, list[int]] = {}
    for id_, raw in parts.items():
        ids.setdefault(raw, []).append(id_)
    found = [(i, j) for i, raw in whole.items() for at in range(len(raw)) for j in ids.get(raw[at:], ())]
    return [j * size + i if turned else i * size + j for i, j in found]


@lru_cache(1)
def aligner_of(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def alignments(docs: DataFrame, a: str = A, b: str = B) -> DataFrame:
    """One row per distinct text that is not null or empty: ``key`` (its SHA-256), copies, n_a, n_b, ``groups``
    (``a1,a2|b1;a3|b2,b3``) and ``links`` (little-endian unsigned 32-bit numbers of linked pairs, one for each link)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner_of(a, b)
        for part in pieces_of(batches, "text"):
            texts = part.column("text").to_pylist()
            found = [own.align(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sha256(t.encode()).digest() for t in texts], pa.binary()), part.column("copies"),
                 pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.binary()).cast(pa.string()),
                 pa.array([f[3].astype("<u4").tobytes() for f in found], pa.binary())],
                ["key", "copies", "n_a", "n_b", "groups", "links"])

    texts = docs.select("text").where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    return texts.mapInArrow(run, "key binary, copies bigint, n_a bigint, n_b bigint, groups string, links binary")


def link_counts(aligned: DataFrame, pairs: int) -> np.ndarray:
    """How often each pair is linked in the corpus: one number for each of the ``pairs`` that can be."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(pairs, np.int64)
        for part in pieces_of(batches, "links"):
            links = [np.frombuffer(x.as_buffer(), "<u4") for x in part.column("links")]
            copies = part.column("copies").to_pylist()
            for times in set(copies):
                same = [x for x, c in zip(links, copies) if c == times]
                held += np.bincount(np.concatenate(same), minlength=pairs) * times
        at = np.flatnonzero(held)
        for start in range(0, len(at), 1 << 16):
            some = at[start:start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["pair", "n"])

    sums = aligned.select("copies", "links").mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    found, counts = sums.toArrow(), np.zeros(pairs, np.int64)  # at most one row per pair
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    return counts


def measured(aligned: DataFrame, a: str = A, b: str = B) -> DataFrame:
    """``aligned`` (a stored table, read twice) with n_groups, n_links, n_best and count_sum instead of the links."""
    pairs = aligner_of(a, b)
    counts = link_counts(aligned, len(pairs.pairs))
    highest = np.zeros(pairs.size, np.int64)
    np.maximum.at(highest, pairs.of_b, counts)
    shared = aligned.sparkSession.sparkContext.broadcast((counts, counts == highest[pairs.of_b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, is_best = shared.value
        for part in pieces_of(batches, "links"):
            links = [np.frombuffer(x.as_buffer(), "<u4") for x in part.column("links")]
            columns = [len, len, lambda x: int(is_best[x].sum()), lambda x: int(number[x].sum())]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), *(pa.array([f(x) for x in links], pa.int64()) for f in columns)],
                [*others, "n_groups", "n_links", "n_best", "count_sum"])

    others = [c for c in aligned.columns if c != "links"]
    kinds = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in others)
    return aligned.mapInArrow(run, f"{kinds}, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint")


def align(docs: DataFrame, a: str = A, b: str = B, digests: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, and ``groups``, or with ``digests`` its
    SHA-256 ('' without tokens) as groups_sha256, in which case the groups are not stored."""
    spark, groups = docs.sparkSession, "groups"
    docs = docs.select("doc_id", "text")
    found = alignments(docs, a, b)
    if digests:
        groups = "groups_sha256"
        hashed = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")
        found = found.select("key", "copies", "n_a", "n_b", hashed.alias(groups), "links")
    path = new_folder(spark)
    found.write.option("compression", "zstd").parquet(path)
    measures = measured(spark.read.schema(found.schema).parquet(path), a, b)
    path = new_folder(spark)
    measures.write.parquet(path)
    measures = spark.read.schema(measures.schema).parquet(path)
    key = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256)))
    rows = docs.select("doc_id", key.alias("key"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    total = measures.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.col("copies") * HOT > total
    near = rows.join(F.broadcast(measures.where(hot)), "key", "left")
    done = near.where("key IS NULL OR copies IS NOT NULL")
    rest = near.where("key IS NOT NULL AND copies IS NULL").select("doc_id", "key")
    both = done.unionByName(rest.join(measures.where(~hot), "key", "left"))
    return both.select("doc_id", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers),
                       F.coalesce(groups, F.lit("")).alias(groups))


def op12_text_alignment(spark, sf_dir: str) -> DataFrame:
    """Measures of the alignment of every document."""
    return align(table(spark, sf_dir, "documents"), digests=True)
