"""Benchmark decontamination by greedy string tiling.

Texts and test items become word hashes. Runs of ``SEED`` words, hashed by
Karp-Rabin, are joined between documents and items; for each pair with a
shared seed, the longest matches free of marked words are marked again and
again, in both, until none of ``SEED`` words is left. Tiles may lie in any
order, so reordered passages count. A document leaks an item if tiles cover
``COVERAGE`` of its words.

Items are a stated query set: equal texts are tiled once, and distinct ones go
to the documents in blocks of up to ``BLOCK_WORDS`` words (an item longer than
that is a block of its own), one pass over the documents per block. A task
holds one block; the driver keeps the blocks of ``find_leaks``, which are one
plan, until its result is read, those of ``drop_leaks`` one at a time.

Defined cases: null texts and items are empty; an item without words leaks
nowhere; one with fewer words than a seed must stand whole; repeated items are
each reported; repeated documents are each reported; empty tables give no
rows; further columns are not read.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as memory
from .common import release, ship, stage, text_slices
from .words import hashed, windows

SEED = 5
COVERAGE = 0.5
BLOCK_WORDS = 1_000_000
LEAKS = "doc_id long, item_id long, item_words long, covered long, coverage double, tiles array<struct<doc_at:int,item_at:int,words:int>>"

_words = re.compile(r"\w+").findall


def word_hashes(text: str | None) -> np.ndarray:
    return hashed(_words((text or "").lower()))


def runs(doc_at: np.ndarray, item_at: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal matches as (length, document position, item position), from shared seeds on the same diagonal."""
    order = np.lexsort((doc_at, doc_at - item_at))
    d, i = doc_at[order], item_at[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(d) != 1) | (np.diff(i) != 1))))
    length = np.diff(np.concatenate((new, [len(d)]))) + size - 1
    return list(zip(length.tolist(), d[new].tolist(), i[new].tolist()))


def tile(matches: list[tuple[int, int, int]], doc_words: int, item_words: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document position, item position, length): longest first, then leftmost; none overlap on either side."""
    doc_free, item_free = np.ones(doc_words, dtype=bool), np.ones(item_words, dtype=bool)
    heap = [(-n, i, d) for n, d, i in matches]
    heapq.heapify(heap)
    tiles = []
    while heap:
        n, i, d = heapq.heappop(heap)
        free = doc_free[d : d - n] & item_free[i : i - n]
        if free.all():
            doc_free[d : d - n] = False
            item_free[i : i - n] = False
            tiles.append((d, i, -n))
            continue
        edge = np.diff(np.concatenate(([0], free.view(np.int8), [0])))
        for begin, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if end - begin >= least:
                heapq.heappush(heap, (begin - end, i + begin, d + begin))
    return tiles


class Items:
    """Hashed items of one block and the positions of their seeds."""

    def __init__(self, rows: list[tuple[int, str]], seed: int) -> None:
        self.seed = seed
        self.ids = [k for k, _ in rows]
        self.words = [word_hashes(t) for _, t in rows]
        seeds, item, at = [], [], []
        self.by_size: dict[int, tuple] = {}
        sizes = sorted({min(seed, len(w)) for w in self.words if len(w)})
        for size in sizes:
            mine = [k for k, w in enumerate(self.words) if min(seed, len(w)) == size and len(w)]
            seeds = [windows(self.words[k], size) for k in mine]
            item = np.repeat(mine, [len(s) for s in seeds])
            at = np.concatenate([np.arange(len(s)) for s in seeds])
            joined = np.concatenate(seeds)
            order = np.argsort(joined, kind="stable")
            bits = 1 << max(16, (8 * len(joined)).bit_length())
            mask = np.zeros(bits, dtype=bool)
            mask[joined & np.uint64(bits - 1)] = True
            self.by_size[size] = (joined[order], item[order], at[order], mask, np.uint64(bits - 1))

    def leaks(self, text: str | None, coverage: float):
        """(item, words, covered, share, tiles) of the items that a text covers."""
        words = word_hashes(text)
        for size, (seeds, item, at, mask, low) in self.by_size.items():
            found = windows(words, size)
            where = np.flatnonzero(mask[found & low])
            if not len(where):
                continue
            first, last = (np.searchsorted(seeds, found[where], side=s) for s in ("left", "right"))
            n = last - first
            if not n.sum():
                continue
            doc_at = np.repeat(where, n)
            hit = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            order = np.argsort(item[hit], kind="stable")
            mine, doc_at, item_at = item[hit][order], doc_at[order], at[hit][order]
            cuts = [0, *(np.flatnonzero(np.diff(mine)) + 1).tolist(), len(mine)]
            for a, b in zip(cuts, cuts[1:]):
                k = int(mine[a])
                total = len(self.words[k])
                if len(np.unique(item_at[a:b])) * size < coverage * total:
                    continue  # even apart from each other, the seeds could not cover enough
                tiles = tile(runs(doc_at[a:b], item_at[a:b], size), len(words), total, size)
                covered = sum(t[2] for t in tiles)
                if covered >= coverage * total:
                    yield self.ids[k], total, covered, covered / total, tiles


def _finder(items, coverage: float):
    def find(batches):
        own = items.value
        for part in (p for batch in batches for p in text_slices(batch, 1)):
            rows = [
                (key, *leak)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                for leak in own.leaks(text, coverage)
            ]
            key, item, total, covered, share, tiles = zip(*rows) if rows else ([],) * 6
            tiles = [[{"doc_at": d, "item_at": i, "words": n} for d, i, n in t] for t in tiles]
            kind = pa.list_(pa.struct([("doc_at", pa.int32()), ("item_at", pa.int32()), ("words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (key, item, total, covered)), pa.array(share, pa.float64()), pa.array(tiles, kind)],
                names=["doc_id", "item_id", "item_words", "covered", "coverage", "tiles"],
            )
        memory.forget()
        release()

    return find


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, int]:
    """Items with the number of their block, and how many blocks there are. Items are hashed into as many
    parts as keep a part's mean at half a block; a part that is still larger is cut by a running sum."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") / 2 + 1
    rows = benchmark.select("item_id", "text").withColumn("_size", size)
    parts = int((rows.agg(F.sum("_size")).first()[0] or 0) // (block_words / 2)) + 1
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    order = Window.partitionBy("_part").orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_cut", F.floor(F.sum("_size").over(order) / block_words))
    blocks = rows.select("_part", "_cut").distinct().orderBy("_part", "_cut").withColumn("_block", F.monotonically_increasing_id())
    numbered = [(r["_part"], r["_cut"], i) for i, r in enumerate(blocks.collect())]
    table = benchmark.sparkSession.createDataFrame(numbered, "_part long, _cut long, _block int")
    return rows.join(F.broadcast(table), ["_part", "_cut"]).select("_block", "item_id", "text"), len(numbered)


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item that it leaks, with the tiles."""
    spark = docs.sparkSession
    ship(spark)
    texts = stage(benchmark.select("text").distinct().select(F.monotonically_increasing_id().alias("item_id"), "text"))
    same = benchmark.select(F.col("item_id").alias("member"), F.col("text").alias("own"))
    members = same.join(texts, F.col("own").eqNullSafe(F.col("text"))).select(F.col("item_id").alias("same"), "member")
    items, n = item_blocks(texts, block_words)
    parts = []
    for block in range(n):
        rows = [(r["item_id"], r["text"]) for r in items.where(F.col("_block") == block).orderBy("item_id", "text").collect()]
        shared = spark.sparkContext.broadcast(Items(rows, seed))
        parts.append(docs.select("doc_id", "text").mapInArrow(_finder(shared, coverage), LEAKS))
    found = parts[0] if parts else spark.createDataFrame([], LEAKS)
    for part in parts[1:]:
        found = found.unionByName(part)
    names = [c.name for c in found.schema]
    return found.join(members, found["item_id"] == members["same"]).select(*(F.col("member").alias(c) if c == "item_id" else c for c in names))


def _cleaner(items, coverage: float):
    def keep(batches):
        own = items.value
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in text_slices(batch, at):
                texts = part.column(at).to_pylist()
                yield part.filter(pa.array([next(own.leaks(t, coverage), None) is None for t in texts], pa.bool_()))
        memory.forget()
        release()

    return keep


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents that leak no item, with all their columns; one pass per block, written between blocks, no shuffle of documents."""
    spark = docs.sparkSession
    ship(spark)
    items, n = item_blocks(benchmark.select("text").distinct().withColumn("item_id", F.lit(0)), block_words)
    shared = None
    for block in range(n):
        if shared is not None:
            docs = stage(docs)
            shared.unpersist()
        rows = [(r["item_id"], r["text"]) for r in items.where(F.col("_block") == block).orderBy("item_id", "text").collect()]
        shared = spark.sparkContext.broadcast(Items(rows, seed))
        docs = docs.mapInArrow(_cleaner(shared, coverage), docs.schema)
    return docs
