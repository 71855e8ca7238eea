"""Importance resampling towards a target distribution, drawn without replacement.

Texts are bags of runs of one and two words, hashed into ``BUCKETS`` buckets by
CRC-32. The counts of all documents and of all target texts give every bucket
a gain, the scaled logarithm of the ratio of its smoothed shares; the weight of
a document is the floored mean gain of its features. Weights are scored in
arrays: the buckets of some MB of text at a time, the CRC of a run of two words
from those of its words. A Gumbel number of the hashed id is added, and the
best of the documents long enough are drawn; exact ranks come from
:mod:`.ranking`.

What is broadcast are ``BUCKETS`` gains. Texts are read twice, once to count
and once to weigh, and travel nowhere.

Words: A-Z become lower case, then runs of digits, a-z and characters outside
ASCII. Defined cases: a null or empty text has no feature, weight 0 and is not
drawn unless ``least_words`` is 0; an empty target gives gains as the formula
does with T = 0; ties go to the smaller id, null ids come last and draw their
number as an empty id, repeated rows are rows of their own; no documents give
no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .ranking import ranked

BUCKETS = 10_000
_SLICE = 1 << 22
_SHORT = 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _shifts() -> np.ndarray:
    """By length and byte of a state: what that byte becomes after so many zero bytes."""
    steps = np.empty((_SHORT + 1, 4, 256), dtype=np.uint32)
    steps[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_SHORT):
        steps[n + 1] = (steps[n] >> 8) ^ _CRC[steps[n] & 255]
    return steps


_SHIFT = _shifts()


def _crc_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes."""
    state = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    active, k = np.flatnonzero(sizes <= _SHORT), 0
    while True:
        active = active[sizes[active] > k]
        if not len(active):
            break
        now = state[active]
        state[active] = (now >> 8) ^ _CRC[(now ^ data[starts[active] + k]) & 255]
        k += 1
    state = ~state
    for i in np.flatnonzero(sizes > _SHORT):
        state[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]])
    return state


def _crc_joined(first: np.ndarray, second: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of ``first``, a space and ``second``, from the CRCs of both; the rest describes the second run."""
    state = ~first
    state = ~((state >> 8) ^ _CRC[(state ^ np.uint32(32)) & 255])
    short = np.minimum(sizes, _SHORT)
    out = second.copy()
    for k in range(4):
        out ^= _SHIFT[short, k, (state >> np.uint32(8 * k)) & 255]
    for i in np.flatnonzero(sizes > _SHORT):
        out[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]], int(state[i]))
    return out


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each feature, bucket of each feature, text of each word), some MB of texts at a time."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    everything = np.frombuffer(values or b"", dtype=np.uint8)
    begin, stop = int(offsets[0]), int(offsets[-1])
    last_text, last_crc = -1, np.uint32(0)
    while begin < stop:
        end = min(begin + _SLICE, stop)
        while end < stop:  # on to the next byte outside of words
            ahead = np.flatnonzero(~_IN_WORD[everything[end : end + 65536]])
            if len(ahead):
                end += int(ahead[0])
                break
            end = min(end + 65536, stop)
        part = everything[begin:end]
        word = _IN_WORD[part]
        data = _LOWER[part]
        cuts = offsets[(offsets > begin) & (offsets < end)] - begin
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        opens[cuts] = word[cuts]
        closes[:-1] &= ~word[1:]
        closes[cuts - 1] = word[cuts - 1]
        starts = np.flatnonzero(opens)
        sizes = np.flatnonzero(closes) + 1 - starts
        owners = np.searchsorted(offsets, starts + begin, side="right") - 1
        begin = end
        if not len(starts):
            continue
        single = _crc_of(data, starts, sizes)
        before = np.concatenate([[last_crc], single[:-1]]).astype(np.uint32)
        joined = np.concatenate([[last_text], owners[:-1]]) == owners
        double = _crc_joined(before[joined], single[joined], data, starts[joined], sizes[joined])
        last_text, last_crc = int(owners[-1]), single[-1]
        yield np.concatenate([owners, owners[joined]]), np.concatenate([single, double]) % BUCKETS, owners


def _counter(batches):
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, buckets, _ in bags(batch.column(0)):
            total += np.bincount(buckets, minlength=BUCKETS)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket."""
    ship(texts.sparkSession)
    rows = texts.select(F.col(text).alias("text")).mapInArrow(_counter, "bucket long, n long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[found["bucket"]] = found["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + BUCKETS) / ((s + 1) * (T + BUCKETS)))) of every bucket."""
    wide, narrow = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((float(t + 1) * wide) / (float(s + 1) * narrow) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def _weigher(gains: np.ndarray):
    def weigh(batches):
        for batch in batches:
            n = batch.num_rows
            words, features, total = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for owners, buckets, of_words in bags(batch.column(1)):
                words += np.bincount(of_words, minlength=n)
                features += np.bincount(owners, minlength=n)
                total += np.bincount(owners, weights=gains[buckets], minlength=n).astype(np.int64)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"]
            )

    return weigh


def weights(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(_weigher(gains), "doc_id long, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) with u from the first 32 bits of SHA-256 of ``seed:key``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, least_words: int = 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document's ``doc_id, n_words, n_features, weight, score`` and, if it is drawn, ``rank``.

    Drawn are ``percent`` per cent, rounded down, of the documents with at
    least ``least_words`` words.
    """
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target, text))
    scored = weights(docs, gains, key, text).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    last = F.coalesce(F.col("doc_id"), F.lit(0))
    found = ranked(scored, [-F.col("score"), F.col("doc_id").isNull().cast("int"), last], F.col("n_words") >= least_words)
    drawn = found.agg(F.count("rank").alias("n")).first()["n"] * percent // 100
    return found.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))


def drawn(docs: DataFrame, target: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """The documents that :func:`resample` draws, with all their columns; rows that repeat a drawn id come along, those with a null id do not."""
    chosen = resample(docs, target, key=key, **how).where("rank IS NOT NULL").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(chosen, key, "left_semi").select(*docs.columns)
