"""Operators 2 and 8."""

import math

import numpy as np
import pytest

from plumbline.llm import prefix_forest, tile_topk


@pytest.fixture(scope="module")
def vectors(shared, folder):
    rows = shared.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    return rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)


def best(ids, vectors, step, k):
    at = np.flatnonzero(ids % step == 0)
    scores = vectors[at] @ vectors.T
    scores[np.arange(len(at)), at] = -np.inf
    return {int(ids[i]): [int(ids[j]) for j in np.lexsort((ids, -row))[:k]] for i, row in zip(at, scores)}


def lists(rows):
    found = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    return found


def test_op8_equals_brute_force(shared, folder, vectors, monkeypatch):
    ids, values = vectors
    monkeypatch.setattr(tile_topk, "SHARD_ROWS", 20)  # a tree of two levels
    assert lists(tile_topk.op8_tile_topk(shared, folder).collect()) == best(ids, np.floor(64 * values), 20, 20)


def test_op2_recall(shared, folder, vectors):
    ids, values = vectors
    got = lists(prefix_forest.nearest(*[shared.read.parquet(f"{folder}/embeddings.parquet")] * 2).collect())
    want = best(ids, values / np.linalg.norm(values, axis=1, keepdims=True), 1, 5)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9


@pytest.fixture(scope="module")
def odd_vectors(shared):
    return shared.createDataFrame(
        [(0, [1.0, 2.0], 1), (0, [1.0, 3.0], 1), (None, [1.0, 1.0], 1), (50, None, 1), (100, [math.nan, 1.0], 1),
         (150, [math.inf, 1.0], 1), (200, [0.0, 0.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2), (4, [1.0], 1),
         (3, [1e300, -1e300], 1), (5, [], 1), (6, [None, 1.0], 1), (250, [1e300, 1e300], 1)],
        "vec_id bigint, embedding array<double>, score int")


def test_op2_odd_rows(odd_vectors):
    got = lists(prefix_forest.nearest(odd_vectors, odd_vectors.where("vec_id % 50 = 0"), 3).collect())
    assert got == {0: [1, 2, 250], 250: [0, 1, 2]}
    assert prefix_forest.nearest(odd_vectors.where("false"), odd_vectors, 3).count() == 0


def test_op8_odd_rows(odd_vectors):
    got = lists(tile_topk.top_k(odd_vectors, odd_vectors.where("vec_id % 50 = 0"), 3).collect())
    assert got == {0: [250, 1, 2], 200: [0, 0, 1], 250: [0, 0, 1]}
    assert tile_topk.top_k(odd_vectors.where("false"), odd_vectors, 3).count() == 0
