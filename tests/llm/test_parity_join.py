"""The parity-sketch join and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import parity_join
from tallyloom.llm.components import components
from tallyloom.llm.parity_join import Rule


def brute(rows, rule):
    """n_shingles and the component id per row."""
    sets = []
    for _, text in rows:
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
        k = min(rule.size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rule.whole * len(sets[i] & sets[j]) >= rule.part * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            best[find(i)] = min(k, best.get(find(i), k))
    return [(k, len(s), best.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(50)]
    texts = [None, "", " \n", "one", "One", "one two", "a b c d", "a b c d e", "A b\tc D e", "é É", "x\xa0y x\xa0y"]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([8, 30, 90, 260, 600]))] for _ in range(12)]
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, len(words) // 40])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
        if rng.random() < 0.3:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 60))] + passage
        texts.append(rng.choice([" ", "\n"]).join(words))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [rows[20], (rows[21][0], rows[30][1]), (None, rows[22][1]), (None, "nobody else says this here")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, row long, root string").repartition(3)


@pytest.mark.parametrize("seed,rule", [(1, Rule(4, 85, 100)), (2, Rule(5, 80, 100)), (3, Rule(1, 60, 100))])
def test_components_are_those_of_all_pairs(spark, seed, rule):
    rows = corpus(seed)
    got = parity_join.components_of(frame(spark, rows), rule).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, brute(rows, rule)))


def test_two_centres_are_not_enough_and_blocks_find_the_rest(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "_BLOCK", 4)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(60):  # a chain: neighbours link, far ones do not
        words = list(base)
        for k in range(i):
            words[2 * k] = f"n{k}"
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    rule = Rule(2, 85, 100)
    got = parity_join.components_of(frame(spark, rows), rule).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, rule))


def test_one_document_of_each_group_stays(spark):
    rows = corpus(4)
    rule = Rule()
    got = parity_join.keep_first(frame(spark, rows), rule)
    assert got.columns == ["doc_id", "text", "row", "root"]
    want = {}
    for (k, t), (_, n, c) in zip(rows, brute(rows, rule)):
        if n:
            want.setdefault(c if c is not None else ("none", t), k)
    kept = got.collect()
    bare = sum(not (t or "").strip(" \t\n\x0b\x0c\r") for _, t in rows)
    assert len(kept) == len(want) + bare
    assert {r.doc_id for r in kept if (r.text or "").strip()} == {c if not isinstance(c, tuple) else None for c in want}
    assert parity_join.keep_first(frame(spark, rows).limit(0), rule).count() == 0


def test_any_column_names_and_thresholds_that_lose_links(spark):
    rows = [(1, "a b c d e f g", 1, 2, 3, 4), (2, "a b c d e f g", 5, 6, 7, 8), (3, None, 1, 2, 3, 4)]
    names = ["doc_id", "text", "_hash0", "_id", "_hash", "__own"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int, b int, c int, d int").toDF(*names)
    kept = parity_join.keep_first(docs, parity_join.Rule(5, 80, 100))
    assert kept.columns == names and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    for part, whole in [(30, 100), (101, 100), (0, 1)]:
        with pytest.raises(ValueError):
            parity_join.Rule(5, part, whole)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, 5, dtype=np.uint64))))
        x, y = parity_join.bits(a), parity_join.bits(b)
        words = min(len(x), len(y))
        apart = np.bitwise_count(parity_join.folded(x, words) ^ parity_join.folded(y, words)).sum()
        assert apart <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 500), (7, 8), (8, 7)] + [(999, 600), (600, 700)]
    rng.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 400)} | {999: 600, 600: 600, 700: 600}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_with_no_marked_place_are_not_shuffled(spark):
    rows = spark.range(0, 3000, 1, 3).select(F.col("id").alias("row"))
    value = F.xxhash64("row")
    some, others = parity_join._split(rows, value, parity_join._marks(rows.where("row % 3 = 0"), value))
    wanted = {r.row for r in rows.where("row % 3 = 0").collect()}
    first, rest = {r.row for r in some.collect()}, {r.row for r in others.collect()}
    assert wanted <= first and len(first) < 1100 and not first & rest and len(first | rest) == 3000
    assert "hashpartitioning(row" not in others._jdf.queryExecution().executedPlan().toString()
    some, others = parity_join._split(rows, value, parity_join._marks(rows.limit(0), value))
    assert some.count() == 0 and others.count() == 3000


def test_parts_with_the_same_members_are_compared_once(spark):
    members = [(1, 10, 10), (1, 11, 11), (2, 10, 10), (2, 11, 11), (3, 10, 10), (3, 12, 12), (4, 10, 10), (4, 13, 10), (5, 10, 10), (5, 11, 11), (5, 12, 12)]
    rooted = spark.createDataFrame(members, "key long, node long, root long")
    assert sorted(map(tuple, parity_join._open_keys(rooted).collect())) == [(1, 2), (3, 2), (5, 3)]


def test_one_row_of_each_set_is_dealt(spark):
    rows = [(i, i % 4 if i < 8 else 0, 1, [i]) for i in range(10)] + [(10, 0, 0, [])]
    rows = spark.createDataFrame([(r, d, d, n, k) for r, d, n, k in rows], "row long, d1 long, d2 long, n_shingles long, keys array<long>")
    classes = rows.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("row").alias("node"))
    assert sorted(r.row for r in parity_join._representatives(rows, classes).collect()) == [0, 1, 2, 3]


def test_a_pair_that_shares_several_parts_is_named_once():
    rule = Rule(1, 80, 100)
    sets = [np.arange(100, dtype=np.uint64) * np.uint64(77) + np.uint64(k) * np.uint64(77) for k in (0, 1, 2)]
    keys = [[3, 5, 9], [5, 9], [3, 9]]

    def named(key):
        there = [i for i, own in enumerate(keys) if key in own]
        rows = [{"key": key, "side": 2, "node": i, "root": i, "n": 100, "bits": parity_join.bits(sets[i]).tobytes(), "firsts": keys[i]} for i in there]
        return sorted(parity_join._near(rows, rule))

    assert [named(k) for k in (3, 5, 9)] == [[(0, 2)], [(0, 1)], [(1, 2)]]
