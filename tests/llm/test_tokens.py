"""Operators 1 and 4."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from plumbline.llm import byte_bpe, packing


def reference():
    with open(byte_bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_equal_the_library_on_odd_texts():
    own, other = byte_bpe.encoder(byte_bpe.RANKS, public_tokenizers.PATTERN), reference()
    random.seed(1)
    parts = [" ", "  ", "\n", "a", "'s", "é", "漢", "😀", "12", ".", "\t", "\x1c", "\x85", "the", "<|endoftext|>", "Hello"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 50))) for _ in range(3000)]
    texts += ["", "a" * 3000, " " * 2000, "ab" * 9000, "é" * 999, "a \n b", "a\n  b", " x ", "x "]
    ids = [np.frombuffer(x, own.type).tolist() for x in own.encode(texts)]
    assert ids == [other.encode_ordinary(t) for t in texts]
    assert [own.decode(i) for i in ids] == [t.encode() for t in texts]


def test_op4_equals_the_library(shared, folder, documents):
    other = reference()
    got = {r["doc_id"]: tuple(r)[1:] for r in byte_bpe.op4_byte_bpe(shared, folder).collect()}
    for doc_id, text, _ in documents:
        ids = other.encode_ordinary(text)
        assert got[doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256(text.encode()).hexdigest())


def test_op4_odd_rows(odd):
    rows = byte_bpe.decode(byte_bpe.encode(odd)).collect()
    assert sorted(bytes(r["decoded"]) for r in rows) == sorted((r["text"] or "").encode() for r in odd.collect())


def test_hilbert_is_a_walk_over_all_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    places = packing.hilbert(cells, 3)
    assert sorted(places.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(1) == 1).all()


def test_packing_ids_equal_the_library_on_odd_texts():
    own, library = packing.Tokens(packing.TOKENIZER), Tokenizer.from_file(packing.TOKENIZER)
    as_text = Tokenizer.from_file(packing.TOKENIZER)
    as_text.encode_special_tokens = True
    random.seed(2)
    parts = [" ", "  ", "\n", "a", "'s", "é", "漢", "😀", "12", ".", "\t", "\x1c", "\x85", "the", "<|endoftext|>", "Hello"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 50))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", "<|endoftext|>" + " " * 60_000]
    texts += ["", "a" * 100_000, " " * 49_999 + "x", " " * 60_000, "x" + "\n " * 1_000_000 + "y", "é" * 99_999]
    for text in texts:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.plain(text).tolist() == as_text.encode(text, add_special_tokens=False).ids
    assert own.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def assert_packed(pieces, ids):
    held = {}
    for p in pieces:
        part = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert zlib.crc32(part.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        held[p["doc_id"]] = held.get(p["doc_id"], 0) + p["length"]
    assert held == {k: len(v) for k, v in ids.items()}


def assert_sequences(pieces, length):
    ends = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends.get(p["sequence_id"], 0)
        ends[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n <= length and n & (n - 1) == 0 for n in ends.values())  # nothing is padded


def test_op1_holds_every_token_once(shared, folder, documents):
    library = Tokenizer.from_file(packing.TOKENIZER)
    ids = {d: np.array(library.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for d, t, _ in documents}
    pieces = packing.op1_packing(shared, folder).collect()
    assert_packed(pieces, ids)
    assert_sequences(pieces, 2048)


def test_op1_odd_rows(odd):
    pieces = packing.pack(odd, 64).collect()
    assert_sequences(pieces, 64)
    assert sum(p["start"] == 0 for p in pieces) == odd.count()
    assert packing.pack(odd.where("false")).count() == 0


def test_alike_documents_are_neighbours():
    rng = np.random.default_rng(0)
    base = [rng.integers(0, 50000, 400) for _ in range(40)]
    near = [np.where(rng.random(400) < 0.02, rng.integers(0, 50000, 400), b) for b in base]
    place = np.argsort(np.argsort(packing.keys_of([*base, *near]), kind="stable"))
    apart = np.abs(place[:40] - place[40:])
    assert np.median(apart) < 8  # 27 if the order were random
