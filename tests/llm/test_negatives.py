"""Operator 11."""

import math

import numpy as np
import pytest

from plumbline.llm import hard_negatives
from plumbline.llm.hard_negatives import Rows, bounds, kth, levels, summaries

COLUMNS = "vec_id bigint, label int, embedding array<double>, vector string, copy int, shard string, `a.b` int"


def brute(rows, asked, positives, negatives, low, high, scale):
    """The contract, on Python's own numbers."""
    def usable(given):
        return [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in given
                if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    rows, once, out = usable(rows), {}, []
    for i, label, v in sorted(usable(asked)):
        once.setdefault(i, (label, v))
    for i, (label, v) in once.items():
        others = [(-score(v, w), j, other) for j, other, w in rows if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in others if x[2] == label)[:positives]:
            fit = sorted(x for x in others if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)
            out += [(i, j, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def found(spark, rows, asked, **given):
    frames = [spark.createDataFrame([(*r, "x", 1, "y", 2) for r in x], COLUMNS) for x in (rows, asked)]
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(*frames, **given).collect())


def vectors(n, length, labels, seed, grid=None):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(labels, length))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = base[label] * 0.6 + rng.normal(size=length) + 0.4
        out.append((i, label, (np.round(v * grid) / grid if grid else v / np.linalg.norm(v)).tolist()))
    return out


def test_bounds_hold_every_score_and_tighten():
    rng = np.random.default_rng(3)
    for length in (2, 5, 17, 64):
        whole = np.floor(rng.normal(2, 60, size=(90, length)))
        raw = whole / 256
        row = type("Row", (), {"ids": np.arange(90).astype("<i8").tobytes(), "labels": np.zeros(90, "<i8").tobytes(),
                               "vectors": raw.astype("<f8").tobytes(),
                               "summary": summaries(whole).astype("<f8").tobytes()})
        rows = Rows(row, 256)
        scores, spans = whole @ whole.T, []
        for i in range(len(levels(length))):
            low, high = bounds(rows, slice(None), rows, i)
            assert (low <= scores).all() and (scores <= high).all()
            spans.append((high - low).sum())
        assert spans == sorted(spans, reverse=True)


def test_kth_is_none_where_too_few():
    values = np.array([[3.0, 1.0, 2.0], [5.0, 6.0, 7.0]])
    allowed = np.array([[True, True, True], [True, False, False]])
    assert kth(values, allowed, 2).tolist() == [2.0, -np.inf]
    assert kth(values, allowed, 9).tolist() == [-np.inf, -np.inf]


@pytest.mark.parametrize("sizes", [(8192, 32768), (37, 5)])
@pytest.mark.parametrize("grid", [None, 2])
def test_equals_brute_force(shared, monkeypatch, sizes, grid):
    """One tile and many; vectors all different, and a coarse grid with many equal scores."""
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", sizes[0])
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", sizes[1])
    rows = vectors(300, 12, 4, 1, grid)
    asked = [r for r in rows if r[0] % 20 == 0]
    want = brute(rows, asked, 5, 3, 50, 95, 256)
    assert want and found(shared, rows, asked) == want


def test_odd_rows(shared):
    """Nulls, other lengths, copies, a hot vector, negative and huge scores."""
    rows = vectors(60, 6, 3, 2) + [(1000 + i, 1, [0.5] * 6) for i in range(40)]
    rows += [(None, 1, [1.0] * 6), (70, None, [1.0] * 6), (71, 1, None), (72, 1, []), (73, 1, [1.0, None] * 3),
             (74, 1, [float("nan")] * 6), (75, 1, [float("inf")] * 6), (76, 1, [0.0] * 6), (77, 2, [-1.0] * 6)]
    rows += [(80, 1, [0.3, 0.1, 0.2]), (81, 1, [0.3, 0.2, 0.2]), (82, 2, [0.2, 0.1, 0.2])]
    rows += [(5, 0, [0.1] * 6)] * 7 + [(5, 2, [0.2] * 6)] * 2
    rows += [(90 + i, i % 2, [1e25 * (i + 1)] * 2) for i in range(6)]
    asked = [r for r in rows if r[0] is None or r[0] % 5 == 0 or r[0] in (77, 80, 91, 1001)]
    most = (1 << 63) - 1
    want = [(*r[:4], min(r[4], most), min(r[5], most)) for r in brute(rows, asked, 5, 3, 50, 95, 256) if r[0] < 90 or r[0] > 99]
    got = [r for r in found(shared, rows, asked) if r[0] < 90 or r[0] > 99]
    assert want and got == sorted(want)


def test_scores_beyond_a_long_are_reported_as_the_largest(shared):
    rows = [(i, i % 2, [1e25 * (i + 1)] * 2) for i in range(6)]
    got = found(shared, rows, rows[:1])
    assert all(r[4] == (1 << 63) - 1 for r in got)


def test_empty_tables(shared):
    rows = vectors(10, 4, 2, 1)
    assert found(shared, [], []) == [] and found(shared, rows, []) == []
    assert found(shared, [(1, 1, [1.0])], [(1, 1, [1.0])]) == []


def test_op11_equals_its_sql(shared, folder):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = sorted(db.sql(hard_negatives.OP11_SQL).select(", ".join(names)).fetchall())
    assert want and sorted(tuple(r[n] for n in names) for r in hard_negatives.op11_segment_negatives(shared, folder).collect()) == want
