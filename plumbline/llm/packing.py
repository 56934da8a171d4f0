"""Packing along a space-filling curve (operator 1).

A document's tokens are hashed into a vector, the vector is projected to a few dimensions, and the point's place on a
Hilbert curve is its key. Documents are range-sorted by key, so neighbours in a sequence are alike, and their tokens
form one stream that is cut every ``length`` tokens. What is left at the stream's end (less than one sequence) is cut
into sequences whose lengths are powers of two, which need no padding: nothing is padded at all.

Rows: a null text counts as empty and holds only its end token; every row, repeated ones too, is packed once (ties in
the key are ordered by document id, then by row); a text of any length is tokenised whole and cut into as many pieces as
it needs; an added token of the file that stands in a text is that token, as in the library; an empty table gives no
pieces; other columns are not looked at.
"""

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pieces_of, running_total, table
from plumbline.session import stored

LENGTH, END = 2048, 1
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WIDE_SPACE = 50_000  # characters
BUCKETS, DIMENSIONS, BITS, SEED = 256, 4, 12, 7


def byte_letters() -> dict[int, int]:
    """The letters that byte-level vocabularies write bytes as: printable ones stand for themselves, the others for
    letters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(others)}


BYTE_LETTERS = byte_letters()


class Tokens:
    """A byte-level tokenizer file's ids.

    The file's vocabulary is merged by tiktoken, which gives the same ids in a third of the time of the library that the
    file belongs to. Only texts with white space longer than its search can step back over go to that library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        raw_of = {letter: byte for byte, letter in BYTE_LETTERS.items()}
        self.ranks = {token.translate(raw_of).encode("latin-1"): id_ for token, id_ in model["vocab"].items()}
        self.fast = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        added = json.loads(self.library.to_str())["added_tokens"]
        if any(t[way] for t in added for way in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens that are not matched as they stand")
        self.added = {t["content"]: t["id"] for t in added}
        longest = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(longest)})").split if longest else lambda text: [text]
        self.type = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.wide = re.compile(rf"\s{{{WIDE_SPACE}}}").search

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text in which special tokens are plain text."""
        if len(text) >= WIDE_SPACE and self.wide(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.type)
        return np.asarray(self.fast.encode_to_numpy(text)).astype(self.type)

    def encode(self, text: str) -> np.ndarray:
        """Ids as the library gives them: its added tokens in a text stand for themselves and cut it."""
        if not any(token in text for token in self.added):
            return self.plain(text)
        parts = [np.array([self.added[x]], self.type) if i % 2 else self.plain(x) for i, x in enumerate(self.split(text))]
        return np.concatenate(parts)


@lru_cache(2)
def tokens_of(path: str) -> Tokens:
    return Tokens(path)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of coordinates in [0, 2**bits)."""
    x = points.astype(np.int64).T.copy()
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the cells, coarse to fine
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(turned, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), top
    while q > 1:
        flip ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | (x[i] >> bit & 1)
    return place


def keys_of(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents from their tokens: signed hashing to BUCKETS, random projection to DIMENSIONS."""
    rng = np.random.default_rng(SEED)
    across = rng.normal(size=(BUCKETS, DIMENSIONS))
    sizes = np.array([len(i) for i in ids])
    flat = np.concatenate(ids).astype(np.uint64) if len(ids) else np.zeros(0, np.uint64)
    mixed = (flat + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS
    sign = 1.0 - 2.0 * (mixed >> np.uint64(63)).astype(np.float64)
    row = np.repeat(np.arange(len(ids)), sizes)
    held = np.bincount(row * BUCKETS + bucket, weights=sign, minlength=len(ids) * BUCKETS).reshape(len(ids), BUCKETS)
    held /= np.maximum(np.sqrt((held ** 2).sum(1, keepdims=True)), 1e-12)
    place = np.clip((held @ across + 2.0) / 4.0, 0.0, 1.0 - 1e-9)
    return hilbert((place * (1 << BITS)).astype(np.int64), BITS)


def tokenized(docs: DataFrame, path: str, end: int) -> DataFrame:
    """_row (unique), doc_id, _key, _n and ``_ids`` (bytes of an array) of each document, written out once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens_of(path)
        last = np.array([end], dtype=own.type)
        for part in pieces_of(batches, "text"):
            arrays = [np.concatenate([own.encode(t or ""), last]) for t in part.column("text").to_pylist()]
            ids = [a.tobytes() for a in arrays]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(keys_of(arrays)), pa.array([len(a) for a in arrays], pa.int64()),
                 pa.array(ids, pa.binary())], ["doc_id", "_key", "_n", "_ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, _key bigint, _n bigint, _ids binary")
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()))


def pack(docs: DataFrame, length: int = LENGTH, path: str = TOKENIZER, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (bytes of little-endian unsigned 32-bit numbers), doc_tokens,
    sequence_id and offset."""
    rows = tokenized(docs, path, end)
    placed, total = running_total(rows.select("_row", "doc_id", "_key", "_n"), ["_key", "doc_id", "_row"], "_n", "_at")
    full = total // length
    tail = [1 << b for b in range(length.bit_length() - 1, -1, -1) if total % length >> b & 1]
    edges = full * length + np.cumsum([0, *tail])

    def cuts(start: int, stop: int) -> np.ndarray:
        inner = np.arange((start // length + 1) * length, min(stop, full * length), length)
        return np.concatenate([[start], inner, edges[(edges > start) & (edges < stop)], [stop]]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = tokens_of(path).type
        for part in pieces_of(batches, "_ids"):
            docs_, starts, sizes, raws, counts, sequences, offsets = [], [], [], [], [], [], []
            ids_of = part.column("_ids")
            for i, (at, n) in enumerate(zip(part.column("_at").to_pylist(), part.column("_n").to_pylist())):
                ids = np.frombuffer(ids_of[i].as_buffer(), dtype=kind).astype("<u4")
                cut = np.unique(cuts(at, at + n))
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    docs_.append(i)
                    starts.append(a - at)
                    sizes.append(b - a)
                    raws.append(ids[a - at:b - at].tobytes())
                    counts.append(n)
                    if a < full * length:
                        sequences.append(a // length)
                        offsets.append(a % length)
                    else:
                        k = int(np.searchsorted(edges, a, side="right")) - 1
                        sequences.append(full + k)
                        offsets.append(a - int(edges[k]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(docs_, pa.int64())), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(raws, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    both = rows.select("_row", "doc_id", "_n", "_ids").join(placed.select("_row", "_at"), "_row")
    return both.select("doc_id", "_n", "_ids", "_at").mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
             "offset bigint")


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents with the checksum of their ids."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
