"""The forest against all pairs."""

import numpy as np
import pytest

from tallyloom.llm import forest


def brute(rows):
    good = [e is not None and l is not None and all(x is not None and np.isfinite(x) for x in e) and any(e) for _, e, l in rows]
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = [np.array(np.float32(e), dtype=float) / np.linalg.norm(np.float32(e).astype(float)) if g else None for (_, e, _), g in zip(rows, good)]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    best = {}
    for i, (k, _, _) in enumerate(rows):
        best[find(i)] = min(k, best.get(find(i), k))
    return [(k, links[i], best[find(i)]) for i, (k, _, _) in enumerate(rows)]


@pytest.mark.parametrize("leaf,cell,chunk", [(256, 16384, 20000), (24, 16384, 20000), (24, 40, 50)])
def test_links_and_components_are_those_of_all_pairs(spark, monkeypatch, leaf, cell, chunk):
    monkeypatch.setattr(forest, "LEAF", leaf)
    monkeypatch.setattr(forest, "CELL", cell)
    monkeypatch.setattr(forest, "_CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for label in (1, 2):
        for _ in range(60):
            base = rng.standard_normal(32)
            for _ in range(rng.integers(1, 6)):
                near = base + rng.standard_normal(32) * rng.choice([0, 0.05, 0.12, 0.2])
                rows.append((k, near.tolist(), label))
                k += 1
        hot = rng.standard_normal(32)
        for _ in range(60):
            rows.append((k, (hot + rng.standard_normal(32) * 0.08).tolist(), label))
            k += 1
    rows += [(k + i, rows[0][1], 1) for i in range(20)] + [(k + 20, rows[0][1], 2), (k + 21, [2 * x for x in rows[0][1]], 1)]
    odd = [None, [], [0.0] * 32, [None] + [1.0] * 31, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, rows[0][1][:31]]
    rows += [(k + 30 + i, e, 1) for i, e in enumerate(odd)] + [(k + 50, rows[0][1], None), (5, rows[5][1], rows[5][2])]
    data = spark.createDataFrame([(i, e, lab, 0) for i, e, lab in rows], "vec_id long, embedding array<float>, label int, node int")
    got = [(r.vec_id, r.n_links, r.component_id) for r in forest.near_copies(data.repartition(3)).collect()]
    assert sorted(got) == sorted(brute(rows))
    assert forest.near_copies(data.limit(0)).count() == 0


@pytest.mark.parametrize("cell,share", [(16384, 0.995), (300, 0.99)])
def test_deep_trees_keep_pairs_at_the_threshold(spark, monkeypatch, cell, share):
    monkeypatch.setattr(forest, "LEAF", 16)
    monkeypatch.setattr(forest, "CELL", cell)
    monkeypatch.setattr(forest, "SAMPLE", 512)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (0.981 * a + np.sqrt(1 - 0.981**2) * b).tolist(), 1)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = forest.near_copies(data)
    assert got.where("n_links = 1").count() >= share * len(rows)
    assert got.where("n_links > 1").count() == 0


def test_upper_trees_part_no_pair_that_as_many_lower_trees_would_keep(spark):
    rng = np.random.default_rng(11)
    n, d = 6000, 64
    center = forest.unit(rng.standard_normal((1, d)))
    a = forest.unit(np.sqrt(0.8) * center + np.sqrt(0.2) * forest.unit(rng.standard_normal((n, d))))
    b = rng.standard_normal((n, d))
    b = forest.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    rows = np.concatenate([a, 0.98 * a + np.sqrt(1 - 0.98**2) * b])
    nodes = spark.createDataFrame([(i, 7, r.tolist()) for i, r in enumerate(rows)], "node long, part long, vector array<double>").localCheckpoint()
    large = nodes.groupBy("part").count().select("part")
    found = forest.upper_cells(nodes, large, 0.98, 512).toPandas()
    cells = found.groupby("node")["cell"].agg(set)
    assert len(cells) == 2 * n and found.groupby("cell").size().max() < 2 * n
    assert sum(cells[i].isdisjoint(cells[n + i]) for i in range(n)) == 0
