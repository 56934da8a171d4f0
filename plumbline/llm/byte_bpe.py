"""Byte-level BPE, encoding and decoding (operator 4).

A segment tree over the byte positions of a piece holds, at each position, the rank of the pair that starts there, and
at its root the leftmost pair of least rank. A merge changes three leaves (the merged pair, its left neighbour and the
pair that is gone) and the nodes above them, so it costs a logarithm of the piece's length. Pieces of one padded length
are merged together as rows of one array; long pieces one by one.

Rows: a null text counts as empty and has no ids. Every row is encoded by itself, so repeated rows and ids do no harm.
"""

import base64
import gc
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import pieces_of, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
NONE = np.int64(1) << 60  # no pair starts here
MIX = np.uint64(0x9E3779B97F4A7C15)
ROWS = 2048               # pieces that are merged together
WIDE = 64                 # pieces longer than this are merged one by one
KEPT, KEPT_LENGTH = 600_000, 40  # strings in a worker's cache, and their longest length
MARKS = frozenset(".,;:!?")


class Encoder:
    """Ranks of one vocabulary, with bounded caches of what frequent pieces encode to."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.type = np.dtype("<u2" if max(self.ranks.values()) < 1 << 16 else "<u4")
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        # The same pairs as an open-addressing table that arrays of keys are looked up in.
        keys = np.array(sorted(pairs), dtype=np.int64)
        size = 1 << (4 * len(keys)).bit_length()
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.keys = np.full(size + 64, -1, dtype=np.int64)
        self.values = np.full(size + 64, NONE, dtype=np.int64)
        for key, slot in zip(keys.tolist(), self.slots(keys).tolist()):
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.values[slot] = key, pairs[key]
        self.find = regex.compile(pattern).findall
        self.crossing = re.compile(r"\s \s|\s \Z").search
        self.known: dict[str, bytes] = {}  # ids of chunks with a space before them
        self.fresh: dict[str, bytes] = {}

    def slots(self, keys):
        return (keys.view(np.uint64) * MIX >> self.shift).astype(np.int64)

    def pair_ranks(self, left, right):
        keys = left << 32 | right
        slot = self.slots(keys)
        there = self.keys[slot]
        ranks = np.where(there == keys, self.values[slot], NONE)
        left_over = np.flatnonzero((there != keys) & (there >= 0))
        while len(left_over):
            slot[left_over] += 1
            there = self.keys[slot[left_over]]
            same = there == keys[left_over]
            ranks[left_over[same]] = self.values[slot[left_over[same]]]
            left_over = left_over[~same & (there >= 0)]
        return ranks

    def merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Encode pieces of at most ``width`` (a power of two) bytes, one per row of a stack of segment trees."""
        n = len(pieces)
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(n, width)
        live = np.arange(width) < lengths[:, None]
        token = np.full((n, width + 1), -1, dtype=np.int64)
        token[:, :width] = np.where(live, self.first[raw], -1)
        after = np.minimum(np.arange(1, width + 2), lengths[:, None])  # a piece's end stands for "no neighbour"
        after[after == lengths[:, None]] = width
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE, dtype=np.int64)
        both = live[:, :-1] & live[:, 1:]
        r, c = np.nonzero(both)
        found = self.pair_ranks(token[r, c], token[r, c + 1])
        ok = found < NONE
        tree[r[ok], width + c[ok]] = found[ok] * width + c[ok]
        half = width
        while half > 1:
            tree[:, half // 2:half] = np.minimum(tree[:, half:2 * half:2], tree[:, half + 1:2 * half:2])
            half //= 2
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            rank, at = np.divmod(tree[rows, 1], width)
            gone = after[rows, at]
            beyond = after[rows, gone]
            prior = before[rows, at]
            token[rows, at], token[rows, gone] = rank, -1
            after[rows, at] = beyond
            before[rows, beyond] = at
            right = np.where(beyond < width, self.pair_ranks(rank, np.maximum(token[rows, beyond], 0)), NONE)
            tree[rows, width + gone] = NONE
            tree[rows, width + at] = np.where(right < NONE, right * width + at, NONE)
            has = prior >= 0
            left = np.where(has, self.pair_ranks(np.maximum(token[rows, prior], 0), rank), NONE)
            tree[rows[has], width + prior[has]] = np.where(left < NONE, left * width + prior, NONE)[has]
            for leaf in (gone, at, np.where(has, prior, at)):
                node = (width + leaf) >> 1
                while node[0]:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node >>= 1
            rows = rows[tree[rows, 1] < NONE]
        flat = token[:, :width]
        keep = flat >= 0
        ids = flat[keep].astype(self.type).tobytes()
        ends = np.cumsum(keep.sum(1)) * self.type.itemsize
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_one(self, piece: bytes) -> bytes:
        """The same for one long piece, with the tree as a list."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        token = [int(self.first[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, none = self.pairs, int(NONE)
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = pairs.get(token[i] << 32 | token[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf, value):
            node = width + leaf
            tree[node] = value
            node >>= 1
            while node:
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            beyond, prior = after[gone], before[at]
            token[at], token[gone], after[at] = rank, -1, beyond
            put(gone, none)
            right = pairs.get(rank << 32 | token[beyond]) if beyond < n else None
            put(at, none if right is None else right * width + at)
            if beyond < n:
                before[beyond] = at
            if prior >= 0:
                left = pairs.get(token[prior] << 32 | rank)
                put(prior, none if left is None else left * width + prior)
        return np.array([t for t in token if t >= 0], dtype=self.type).tobytes()

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        done, groups = {}, {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            if whole is not None:
                done[piece] = np.array([whole], dtype=self.type).tobytes()
            elif len(raw) > WIDE:
                done[piece] = self.merge_one(raw)
            else:
                groups.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
        for width, rows in groups.items():
            for i in range(0, len(rows), ROWS):
                some = rows[i:i + ROWS]
                done.update(zip([p for p, _ in some], self.merge_rows([r for _, r in some], width)))
        return done

    def chunks_of(self, text: str) -> list[str]:
        """Cut at single spaces: a chunk, then chunks that stand for themselves with a space before. No match of the
        pattern crosses such a cut unless white space stands on both sides of the space, or before it at the end of the
        text; a text that has this is one chunk."""
        return [text] if self.crossing(text) else text.split(" ")

    def split(self, chunk: str) -> list[str]:
        """The pattern's matches in a chunk. A word of letters after at most one space, and such a word with one mark
        after it, need no search."""
        if chunk.removeprefix(" ").isalpha():
            return [chunk]
        if chunk[-1] in MARKS and chunk[:-1].removeprefix(" ").isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.find(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as an array's bytes."""
        gc.disable()  # many lists and no cycles
        try:
            return self.encoded(texts)
        finally:
            gc.enable()

    def encoded(self, texts: list[str]) -> list[bytes]:
        cut = [self.chunks_of(t) for t in texts]
        heads = {chunks[0] for chunks in cut}
        found = {h: self.split(h) if h else [] for h in heads}
        known = self.known
        got = [list(map(known.get, chunks)) for chunks in cut]
        new = {c for chunks, ids in zip(cut, got) if None in ids for c, i in zip(chunks, ids) if i is None}
        spaced = {c: self.split(" " + c) for c in new}
        fresh, missing = self.fresh, []
        for piece in {p for cuts in (found, spaced) for ps in cuts.values() for p in ps}:
            if piece not in fresh:
                ids = known.get(piece[1:]) if piece[0] == " " else None
                if ids is None:
                    missing.append(piece)
                else:
                    fresh[piece] = ids
        fresh.update(self.encode_pieces(missing))
        join = lambda ps: b"".join([fresh[p] for p in ps])
        of_new = {c: join(ps) for c, ps in spaced.items()}
        for chunks, ids in zip(cut, got):
            if None in ids:
                ids[:] = [of_new[c] if i is None else i for c, i in zip(chunks, ids)]
            ids[0] = join(found[chunks[0]])
        if len(known) > KEPT:
            self.known = {c: i for chunks, ids in zip(cut, got) for c, i in zip(chunks[1:], ids[1:])
                          if len(c) <= KEPT_LENGTH}
        else:
            known.update((c, i) for c, i in of_new.items() if len(c) <= KEPT_LENGTH)
        self.fresh = {p: i for p, i in fresh.items() if len(p) < 4}  # marks and the like, which words end in
        return [b"".join(ids) for ids in got]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def list_array(parts: list[bytes], kind: np.dtype) -> pa.ListArray:
    lengths = np.array([0, *[len(p) // kind.itemsize for p in parts]], dtype=np.int64)
    flat = np.frombuffer(b"".join(parts), dtype=kind).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths).astype(np.int32)), pa.array(flat))


def encode(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and ``ids`` (array of int) of each row's whole text; no special tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for part in pieces_of(batches, "text"):
            ids = own.encode([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), list_array(ids, own.type)], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ``ids`` and ``decoded`` (bytes) of rows with ids; null ids count as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [own.decode(ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.binary())],
                    ["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids of every whole text and their bytes again, as digests."""
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
