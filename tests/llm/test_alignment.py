"""Operator 12."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from plumbline.llm import token_alignment
from plumbline.llm.packing import BYTE_LETTERS
from plumbline.llm.token_alignment import A, B

NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def tokens_of(text, libraries):
    """(id, bytes) of both libraries' tokens, none where they spell another text."""
    a, b = libraries
    byte_of = {chr(letter): byte for byte, letter in BYTE_LETTERS.items()}
    left = [(i, bytes(byte_of.get(c, ord(c)) for c in a.id_to_token(i))) 
            for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
             for i in b.encode(text)]
    raw = (" " + text).encode()
    both = text and b"".join(x for _, x in left) == raw and b"".join(x for _, x in right) == raw
    return (left, right) if both else ([], [])


def links_and_groups(left, right):
    """Walk both lists by the byte where each token ends."""
    links, groups, i, j, at_a, at_b, own_a, own_b = [], [], 0, 0, 0, 0, [], []
    while i < len(left) or j < len(right):
        if at_a <= at_b:
            own_a.append(left[i][0])
            at_a += len(left[i][1])
            i += 1
        else:
            own_b.append(right[j][0])
            at_b += len(right[j][1])
            j += 1
        if at_a == at_b:
            links.append((own_a[-1], own_b[-1]))
            groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
            own_a, own_b = [], []
    return links, ";".join(groups)


def brute(texts, libraries):
    found = {t: (*tokens_of(t or "", libraries),) for t in set(texts)}
    linked = {t: links_and_groups(*found[t]) for t in found}
    counts = Counter()
    for t in texts:
        counts.update(linked[t][0])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return {t: (len(found[t][0]), len(found[t][1]), len(links), len(links),
                sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), groups)
            for t, (links, groups) in linked.items()}


def hashed(groups):
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def test_pairs_that_end_together_are_all_known(libraries):
    own = token_alignment.aligner_of(A, B)
    assert len(own.pairs) < 400_000
    random.seed(5)
    parts = [" ", "  ", "\n", "a", "'s", "é", "漢", "😀", "12", ".", "\t", "\x1c", "\x85", "the", "<|endoftext|>", "Hello",
             "<s>", "</s>", "<unk>", "<0x41>", "▁", "ﬁ", "​", " ", "ab", "ing", "\x00"]
    for _ in range(2000):
        text = "".join(random.choices(parts, k=random.randint(1, 40)))
        left, right = tokens_of(text, libraries)
        links, groups = links_and_groups(left, right)
        n_a, n_b, got, linked = own.align(text)
        assert (n_a, n_b, got.decode()) == (len(left), len(right), groups)
        assert [(int(p) // own.size, int(p) % own.size) for p in own.pairs[linked]] == links


def test_op12_equals_brute_force(shared, folder, documents, libraries):
    want = brute([t for _, t, _ in documents], libraries)
    got = token_alignment.op12_text_alignment(shared, folder).collect()
    assert len(got) == len(documents)
    text_of = {d: t for d, t, _ in documents}
    for r in got:
        expected = want[text_of[r["doc_id"]]]
        assert tuple(r[c] for c in NUMBERS) == expected[:6] and r["groups_sha256"] == hashed(expected[6])


@pytest.mark.parametrize("hot", [1000, 3])
def test_odd_rows(shared, odd, libraries, monkeypatch, hot):
    """Every row once, hot texts or none; texts that no tokens spell give zeros."""
    monkeypatch.setattr(token_alignment, "HOT", hot)
    more = [(10 + i, "the same text again") for i in range(30)] + [(50, "▁ a"), (51, "a\u0000b")]
    docs = odd.select("doc_id", "text").unionByName(shared.createDataFrame(more, "doc_id bigint, text string"))
    docs = docs.selectExpr("*", "1 AS key", "2 AS copies", "'x' AS links", "'y' AS `n_a`", "0 AS `a.b`")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute([t for _, t in rows], libraries)
    got = token_alignment.align(docs).collect()
    assert sorted((repr(r["doc_id"]), *(r[c] for c in NUMBERS), r["groups"]) for r in got) == sorted(
        (repr(i), *want[t]) for i, t in rows)
    assert want["▁ a"][0] == 0 and want["the same text again"][0] > 0
    assert token_alignment.align(docs.where("false")).count() == 0
