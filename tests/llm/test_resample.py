"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import ranking, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def features(text):
    words = WORDS((text or "").translate(LOWER))
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    wide, narrow = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for key, text in rows:
        words, found = features(text)
        gains = [math.floor(1000 * math.log(float(t[b] + 1) * wide / (float(s[b] + 1) * narrow))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        out.append([key, len(words), len(found), weight, score, None])
    long = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(long[: 25 * len(long) // 100], 1):
        r[5] = place
    return out


def _texts(seed, n):
    rng = random.Random(seed)
    bits = ["a", "B", " ", "é", "-", "Word", "x" * 40, "\n", "漢字", "9", "the ", "of "]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(120))) for _ in range(n)]


@pytest.mark.parametrize("size", [1 << 22, 16])
def test_bags_are_those_of_plain_words(monkeypatch, size):
    monkeypatch.setattr(resample, "_SLICE", size)
    texts = [None, "", " ", "A", "x" * 100 + " é漢字 " + "y" * 40, "漢" * 50 + " z " + "漢" * 20, "w " * 5000, *_texts(2, 150)]
    for column in (pa.array(texts), pa.array(["skipped", *texts]).slice(1)):
        got, words = {i: Counter() for i in range(len(texts))}, Counter()
        for owners, buckets, of_words in resample.bags(column):
            for i, b in zip(owners.tolist(), buckets.tolist()):
                got[i][b] += 1
            words.update(of_words.tolist())
        for i, text in enumerate(texts):
            plain, found = features(text)
            assert got[i] == Counter(found) and words[i] == len(plain)


def test_draw_is_that_of_the_plain_version(spark):
    texts = [*_texts(3, 500), None, "", "one " * 20000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, texts[7]), (None, texts[9])]
    target = _texts(4, 20) + [None]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, rank int, score int, run string")
    found = resample.resample(docs.repartition(5), spark.createDataFrame([(t,) for t in target], "text string"))
    got = [[r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]] for r in found.collect()]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(got, key=key) == sorted(brute(rows, target), key=key)
    chosen = {r[0] for r in got if r[5]} - {None}
    kept = resample.drawn(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == chosen
    none = resample.resample(docs.limit(0), spark.createDataFrame([], "text string"))
    assert none.count() == 0
    alone = resample.resample(docs, spark.createDataFrame([], "text string")).orderBy("rank").where("rank = 1").count()
    assert alone == 1


def test_ranks_with_ties_and_a_hot_key(spark):
    data = spark.range(0, 4000, 1, 7).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 7919 % 100).alias("a"), (F.col("id") % 11).alias("b"))
    got = ranking.ranked(data, [-F.col("a"), F.col("b")], F.col("b") != 3)
    entered = sorted((r["rank"], -r.a, r.b) for r in got.where("rank IS NOT NULL").collect())
    assert [r[0] for r in entered] == list(range(1, len(entered) + 1))
    assert [r[1:] for r in entered] == sorted(r[1:] for r in entered)
    assert got.where("rank IS NULL").count() == data.where("b = 3").count()
