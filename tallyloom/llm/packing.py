"""Packing token sequences by cutting-stock column generation.

A document longer than the capacity is cut into full pieces and a rest. Pieces
are counted by length class (a few tokens wide). Over this histogram a linear
program asks for the fewest sequences: columns are patterns (how many pieces
of each class a sequence takes), a knapsack recursion over the capacity prices
them by the duals, and columns enter until the bound from the prices lies
within ``TOLERANCE`` of the value. Multiples are rounded down, what remains is
dealt by first fit over the histogram, largest class first. Pieces of a class
are ranked, and each pattern takes a range of ranks.

The driver holds counts per class and bucket only, a fixed number of figures
whatever the input; pieces never leave the executors.

Defined cases: a null text is an empty one and yields the end token alone;
repeated rows are packed one by one; equal pieces are ranked by id, start and
checksum; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .common import release, ship, stage, text_slices
from .tokens import coder

CAPACITY = 2048
QUANTUM = 8
BUCKETS = 256
TOLERANCE = 0.0005
REMEMBERED = 1_000_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cutter(vocabulary: str, end_id: int, capacity: int, remembered: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        words.forget()
        release()
        for part in (p for batch in batches for p in text_slices(batch, 1, 1024, 1 << 20)):
            keys, texts = part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]
            rows = []
            for key, ids in zip(keys, coder(vocabulary, True, remembered).encode(texts)):
                ids += end
                total, view = len(ids) // 4, memoryview(ids)
                for begin in range(0, total, capacity):
                    n = min(capacity, total - begin)
                    rows.append((key, begin, n, zlib.crc32(view[4 * begin : 4 * (begin + n)]), total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )
        release()

    return cut


def cut_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, remembered: int = REMEMBERED) -> DataFrame:
    """Encode every document and cut it at multiples of the capacity. ``remembered``: word forms a worker keeps, some 200 bytes each."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_cutter(vocabulary, end_id, capacity, remembered), PIECES)


def price(duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value of a pattern and the pattern; class ``i`` takes ``i + 1`` units, unused ones have a negative dual."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        values = duals[:c] + best[c - 1 :: -1][:c]
        k = int(values.argmax())
        if values[k] > best[c - 1]:
            best[c], pick[c] = values[k], k
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(duals), dtype=np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[pick[c]] += 1
            c -= pick[c] + 1
    return float(best[capacity]), pattern


def solve(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Columns and multiples of the linear program over the classes with a demand."""
    used = np.flatnonzero(demand)
    m = len(used)
    columns = np.diag(capacity // (used + 1)).astype(float)
    inverse, x = np.diag(1 / np.diag(columns)), demand[used] / np.diag(columns)
    duals, turns = np.full(len(demand), -1.0), 0
    while m:
        y = inverse.sum(axis=0)
        duals[used] = np.maximum(y, -1e-9)
        value, pattern = price(duals, capacity)
        if value <= 1 + TOLERANCE:
            break
        entering = pattern[used].astype(float)
        step = inverse @ entering
        rising = step > 1e-9
        ratio = np.where(rising, x / np.where(rising, step, 1), np.inf)
        out = int(ratio.argmin())
        t = max(ratio[out], 0.0)
        x = np.maximum(x - t * step, 0)
        x[out] = t
        columns[:, out] = entering
        turns += 1
        if turns % 100 == 0:
            inverse = np.linalg.inv(columns)
            x = np.maximum(inverse @ demand[used], 0)
        else:
            row = inverse[out] / step[out]
            inverse = inverse - np.outer(step, row)
            inverse[out] = row
    patterns = []
    for k in range(m):
        whole = np.zeros(len(demand), dtype=np.int64)
        whole[used] = columns[:, k].astype(np.int64)
        patterns.append((whole, float(x[k])))
    return patterns


def plan(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole multiples that use up the demand exactly."""
    left, chosen = demand.astype(np.int64).copy(), []
    for pattern, times in solve(demand, capacity):
        n = int(min(times + 1e-6, *(left[pattern > 0] // pattern[pattern > 0]))) if pattern.any() else 0
        if n > 0:
            chosen.append((pattern, n))
            left -= n * pattern
    while left.any():
        room, pattern = capacity, np.zeros(len(left), dtype=np.int64)
        for k in np.flatnonzero(left)[::-1]:
            take = min(int(left[k]), room // (k + 1))
            pattern[k] = take
            room -= take * (k + 1)
        n = int((left[pattern > 0] // pattern[pattern > 0]).min())
        chosen.append((pattern, n))
        left -= n * pattern
    return chosen


def _assignments(chosen: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, rank after the last, pieces per sequence, first sequence) for every use of a class."""
    rows, ranks, sequence = [], {}, 0
    for pattern, n in chosen:
        for k in np.flatnonzero(pattern).tolist():
            begin = ranks.get(k, 0)
            ranks[k] = begin + n * int(pattern[k])
            rows.append((k, begin, ranks[k], int(pattern[k]), sequence))
        sequence += n
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, quantum: int = QUANTUM, buckets: int = BUCKETS) -> DataFrame:
    """Give every piece a sequence and an offset in it. Columns ``doc_id, start, length, ids_crc32`` are read."""
    spark = pieces.sparkSession
    key = F.xxhash64("doc_id", "start", "ids_crc32")
    pieces = pieces.withColumn("_class", F.ceil(F.col("length") / quantum).cast("int") - 1).withColumn(
        "_bucket", F.pmod(key, F.lit(buckets)).cast("int")
    )
    units = capacity // quantum
    demand, base = np.zeros(units, dtype=np.int64), []
    for k, b, n in sorted(tuple(r) for r in pieces.groupBy("_class", "_bucket").count().collect()):
        base.append((k, b, int(demand[k])))
        demand[k] += n
    begins = spark.createDataFrame(base, "_class int, _bucket int, _base long").coalesce(1)
    uses = spark.createDataFrame(
        _assignments(plan(demand, units)), "_class int, _first long, _after long, _per long, _sequence long"
    ).coalesce(1)
    within = Window.partitionBy("_class", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("_n", F.row_number().over(within) - 1)
        .join(F.broadcast(begins), ["_class", "_bucket"])
        .withColumn("_rank", F.col("_base") + F.col("_n"))
    )
    uses = uses.withColumnRenamed("_class", "_use")
    placed = ranked.join(
        F.broadcast(uses),
        (F.col("_class") == F.col("_use")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_after")),
    ).withColumn("sequence_id", F.col("_sequence") + F.floor((F.col("_rank") - F.col("_first")) / F.col("_per")))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.drop("_class", "_bucket", "_n", "_base", "_rank", "_use", "_first", "_after", "_per", "_sequence")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY, remembered: int = REMEMBERED) -> DataFrame:
    """Encode, cut and pack all documents; the pieces are written once, as they are read for counts and places."""
    return pack(stage(cut_pieces(docs, vocabulary, end_id, capacity, remembered)), capacity)
