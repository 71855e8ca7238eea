"""The tree search against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import negatives


def brute(rows, scale=256):
    def good(i, e, label):
        return i is not None and label is not None and bool(e) and all(x is not None and np.isfinite(x) for x in e)

    known = [(i, [int(np.floor(scale * np.float32(x).astype(float))) for x in e], label) for i, e, label in rows if good(i, e, label)]
    out = []
    for anchor in sorted({r[0] for r in known if r[0] % 10 == 0}):
        _, label, v = min((r[0], r[2], r[1]) for r in known if r[0] == anchor)
        scored = [(sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in known if i != anchor and len(w) == len(v)]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, positive, _ in [r for r in scored if r[2] == label][:5]:
            fits = [r for r in scored if r[2] != label and 80 * p <= 100 * r[0] <= 100 * p][:5]
            out += [(anchor, positive, k, i, p, s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def _rows(seed, n, size=12):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((8, size))
    out = []
    for i in range(n):
        v = centers[rng.integers(8)] + rng.standard_normal(size) * rng.choice([0.1, 0.3, 1.0])
        out.append((i, (v / np.linalg.norm(v) * rng.choice([1, 1, 2])).tolist(), int(rng.integers(4))))
    hot = out[1][1]  # a third of all rows
    return out + [(n + i, hot, int(rng.integers(4))) for i in range(n // 2)]


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("chunk,block,leaf,least,per", [(2048, 1024, 128, 16, 128), (40, 7, 8, 4, 8)])
def test_negatives_are_those_of_all_pairs(spark, monkeypatch, chunk, block, leaf, least, per):
    for name, value in [("CHUNK", chunk), ("BLOCK", block), ("_LEAF", leaf), ("_LEAST", least), ("_ROWS_A_SAMPLE", per), ("_SIDE", 2)]:
        monkeypatch.setattr(negatives, name, value)
    rows = _rows(3, 260)
    odd = [None, [], [None] + [1.0] * 11, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, rows[0][1][:5], rows[20][1][:5], [0.0] * 12, [-9.0] * 12, [3e6] * 12]
    rows += [(1000 + i, e, i % 2) for i, e in enumerate(odd)] + [(1100, rows[0][1], None), (None, rows[0][1], 1), (20, rows[20][1], rows[20][2]), (30, rows[5][1], 3), (33, rows[33][1], rows[33][2])]
    data = spark.createDataFrame([(i, e, lab, "x", 1) for i, e, lab in rows], "vec_id long, embedding array<float>, label int, cell string, row int")
    found = negatives.mine(data.repartition(3), F.col("vec_id") % 10 == 0)
    got = [tuple(r) for r in found.select(*COLUMNS).collect()]
    assert len(got) > 300 and sorted(got) == brute(rows)


def test_empty_tables_and_no_anchors(spark):
    data = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)], "vec_id long, embedding array<double>, label int")
    assert negatives.mine(data, F.lit(False)).count() == 0
    assert negatives.mine(data.limit(0), F.lit(True)).count() == 0


def test_visits_leave_siblings_out_and_lose_none():
    rng = np.random.default_rng(1)
    centers = rng.integers(-100, 100, (20, 8))
    rows = np.concatenate([c + rng.integers(-3, 4, (200, 8)) for c in centers])
    tree, leaves, _ = negatives.grow(rows, 50, rng)
    known = {}
    for found in negatives.ranges(tree, rows):
        known.setdefault(found[0], []).append(found)
    negatives.fill(tree, known)
    at = negatives.deal(tree, rows)
    scores = negatives.products(rows[::50], rows)
    high = scores.max(axis=1)[:, None]
    low = high * 8 // 10
    seen = np.zeros((len(high), leaves), dtype=bool)
    for leaf, anchors in negatives.visits(tree, rows[::50], low, high):
        seen[anchors, leaf] = True
    inside = (scores >= low) & (scores <= high)
    assert all(seen[i, at[np.flatnonzero(inside[i])]].all() for i in range(len(high)))
    assert seen.mean() < 0.5
