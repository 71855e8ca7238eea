"""Hard negatives by exact search in a multiway tree of hyperplanes with distance ranges.

A split takes some far-apart vectors as split points; every vector goes to its
nearest one. For each split point the tree keeps the range of its distances to
the vectors below every sibling. A window of scores is an annulus of distances
around the anchor, as the norms below a child are known too: a child is left
out when, for some split point, the range of its distances does not meet the
annulus seen from there. What is left are leaves, whose vectors are compared
exactly, in blocks.

The upper splits are fitted on a bounded sample and sent to all tasks; all
vectors are dealt by them into cells, cells into chunks of about ``CHUNK``,
each of which grows the lower splits over all its vectors. Distances of the
upper ranges are those of all vectors, gathered with the chunks. Anchors visit
the cells that survive; chunks and blocks of anchors meet in tasks of at most
``_SIDE * _SIDE`` pairs each, however large a cell is. Each pair keeps the best
few per window, so nothing grows with the vectors a window holds.

Positives come first: the anchor's own cell gives a bound, the other cells are
searched from there on. Then each positive opens a window for negatives.

Components x become floor(scale * x); a score is the whole-numbered inner
product (below 2^63). Defined cases: rows whose id, label or vector is null or
whose vector is empty or holds null or non-finite components take no part;
vectors of different lengths do not meet; a row that has the anchor's id is no
partner of it; an anchor whose id is repeated searches once, with the row of the
smallest label and vector; other repeated rows are rows of their own, so
equal ones take several ranks; negative windows (of a positive below zero) are
empty if ``low < high``; an empty table, or no anchors, gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, ship, stage

SAMPLE = 8192
WAYS = 16
CHUNK = 2048
BLOCK = 1024
_ROWS_A_SAMPLE = 128
_LEAST = 16
_LEAF = 128
_DEPTH = 6
_SIDE = 16
_ANY = 2**62
_SLACK = 1e-9
_POINT = "row long, vec_id long, label long, v array<long>, cell string"


@dataclass
class Split:
    """Split points, what lies below each (a split or a leaf's number), and what is known of it."""

    number: int
    points: np.ndarray
    below: list
    #: By split point and child: range of distances. By child: range of squared norms.
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    thin: np.ndarray | None = None
    thick: np.ndarray | None = None


def _norms(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return np.einsum("ij,ij->i", rows, rows)


def _squares(rows: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances and a bound of their rounding errors."""
    sums = _norms(rows)[:, None] + _norms(points)[None, :]
    return sums - 2 * (rows.astype(np.float64) @ points.astype(np.float64).T), _SLACK * sums


def _far_apart(rows: np.ndarray, ways: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``ways`` distinct rows, each far from those before."""
    some = rows[rng.permutation(len(rows))[: 8 * ways]]
    chosen, gap = [0], np.full(len(some), np.inf)
    while True:
        squares, errors = _squares(some, some[chosen[-1:]])
        gap = np.minimum(gap, np.where(squares[:, 0] > errors[:, 0], squares[:, 0], 0))
        if len(chosen) == ways or gap.max() <= 0:
            return some[chosen]
        chosen.append(int(gap.argmax()))


def grow(rows: np.ndarray, least: int, rng: np.random.Generator) -> tuple[object, int, int]:
    """(tree, number of leaves, number of splits); leaves are left at about ``least`` rows, or where all rows are equal."""
    count = [0, 0]

    def split(own: np.ndarray, depth: int):
        ways = min(WAYS, len(own) // least)
        points = _far_apart(own, ways, rng) if ways > 1 and depth else None
        if points is None or len(points) < 2:
            count[0] += 1
            return count[0] - 1
        number = count[1]
        count[1] += 1
        nearest = _squares(own, points)[0].argmin(axis=1)
        return Split(number, points, [split(own[nearest == k], depth - 1) for k in range(len(points))])

    return split(rows, _DEPTH), *count


def deal(tree, rows: np.ndarray) -> np.ndarray:
    """Leaf of each row."""
    leaves = np.zeros(len(rows), dtype=np.int64)
    todo = [(tree, np.arange(len(rows)))]
    while todo:
        node, at = todo.pop()
        if not isinstance(node, Split):
            leaves[at] = node
            continue
        nearest = _squares(rows[at], node.points)[0].argmin(axis=1)
        todo += [(below, at[nearest == k]) for k, below in enumerate(node.below) if (nearest == k).any()]
    return leaves


def ranges(tree, rows: np.ndarray) -> Iterator[tuple]:
    """(split, child, point, near, far, thin, thick) of these rows for every split they pass."""
    todo = [(tree, np.arange(len(rows)))]
    while todo:
        node, at = todo.pop()
        if not isinstance(node, Split):
            continue
        squares, errors = _squares(rows[at], node.points)
        nearest, norms = squares.argmin(axis=1), _norms(rows[at])
        near, far = np.sqrt(np.maximum(squares - errors, 0)), np.sqrt(squares + errors)
        for k, below in enumerate(node.below):
            own = nearest == k
            if own.any():
                least, most = near[own].min(axis=0), far[own].max(axis=0)
                thin, thick = norms[own].min() * (1 - _SLACK), norms[own].max() * (1 + _SLACK)
                yield from ((node.number, k, i, least[i], most[i], thin, thick) for i in range(len(least)))
                todo.append((below, at[own]))


def fill(tree, known: dict[int, list[tuple]]) -> None:
    """Put ranges into the splits; a child without any has no rows."""
    todo = [tree]
    while todo:
        node = todo.pop()
        if isinstance(node, Split):
            n = len(node.points)
            node.near, node.far = np.full((n, n), np.inf), np.full((n, n), -np.inf)
            node.thin, node.thick = np.full(n, np.inf), np.full(n, -np.inf)
            for _, child, point, near, far, thin, thick in known.get(node.number, ()):
                node.near[point, child] = min(near, node.near[point, child])
                node.far[point, child] = max(far, node.far[point, child])
                node.thin[child] = min(thin, node.thin[child])
                node.thick[child] = max(thick, node.thick[child])
            todo += node.below


def visits(tree, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, positions of the rows that must see it). ``low`` and ``high``: windows of scores, a column each; low > high is none."""
    todo = [(tree, np.arange(len(rows)))]
    low, high = (np.where(np.abs(x) >= _ANY, np.sign(x) * np.inf, x) for x in (low.astype(np.float64), high.astype(np.float64)))
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, Split):
            yield node, at
            continue
        squares, errors = _squares(rows[at], node.points)
        near, far = np.sqrt(np.maximum(squares - errors, 0)), np.sqrt(squares + errors)
        own = _norms(rows[at])[:, None]
        least = np.maximum(node.near[None] - far[:, :, None], near[:, :, None] - node.far[None]).max(axis=1)
        most = (far[:, :, None] + node.far[None]).min(axis=1)
        alive = np.zeros((len(at), len(node.points)), dtype=bool)
        for k in range(low.shape[1]):
            lo, hi = low[at, k, None], high[at, k, None]
            inner, outer = own + node.thin - 2 * hi, own + node.thick - 2 * lo
            spare = _SLACK * (own + node.thick + 1)
            inner, outer = np.sqrt(np.maximum(inner - spare, 0)), np.sqrt(np.maximum(outer + spare, -1) + 0j).real
            alive |= (lo <= hi) & np.isfinite(node.thin) & (least <= outer * (1 + _SLACK)) & (most * (1 + _SLACK) >= inner)
        todo += [(below, at[alive[:, k]]) for k, below in enumerate(node.below)]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if largest < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def _packed(values: np.ndarray) -> np.ndarray:
    largest = np.abs(values).max(initial=0)
    return values.astype(np.int16 if largest < 2**15 else np.int32 if largest < 2**31 else np.int64)


def _matrix(lists: pd.Series) -> np.ndarray:
    return np.stack(lists.to_numpy()).astype(np.int64)


def _dealer(trees: dict):
    """Names the cell of each vector: its length and its leaf in the tree of that length."""

    def cells(vectors: pd.Series) -> pd.Series:
        out = pd.Series("", index=vectors.index, dtype=object)
        for size, own in vectors.groupby(vectors.map(len)):
            leaves = deal(trees[size], _matrix(own)) if size in trees else np.zeros(len(own), dtype=np.int64)
            out[own.index] = [f"{size}/{leaf}" for leaf in leaves]
        return out

    return cells


def _packer(trees: dict):
    """A chunk as one row: its tree over vectors in order of their ids, and what it tells of the upper ranges."""

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        rows = _matrix(pdf["v"])
        upper = list(ranges(trees[rows.shape[1]], rows)) if rows.shape[1] in trees else []
        tree, leaves, _ = grow(rows, _LEAF, np.random.default_rng(len(rows)))
        known: dict[int, list] = {}
        for found in ranges(tree, rows):
            known.setdefault(found[0], []).append(found)
        fill(tree, known)
        at = deal(tree, rows)
        data = pickle.dumps((tree, [np.flatnonzero(at == k) for k in range(leaves)], pdf["vec_id"].to_numpy(), pdf["label"].to_numpy(), _packed(rows)))
        told = [(rows.shape[1], *map(int, f[:3]), *map(float, f[3:])) for f in upper]
        return pd.DataFrame({"cell": [key[0]], "chunk": [int(key[1])], "chunk_data": [data], "told": [told]})

    return pack


_CHUNK_SCHEMA = (
    "cell string, chunk long, chunk_data binary, "
    "told array<struct<size: long, split: long, child: long, point: long, near: double, far: double, thin: double, thick: double>>"
)


def _pack_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """A block of anchors as one row; windows are padded by empty ones."""
    width = int(pdf["lows"].map(len).max())
    low, high = np.full((len(pdf), width), _ANY), np.full((len(pdf), width), -_ANY)
    for i, (lows, highs) in enumerate(zip(pdf["lows"], pdf["highs"])):
        low[i, : len(lows)], high[i, : len(highs)] = lows, highs
    data = pickle.dumps((pdf["vec_id"].to_numpy(), pdf["label"].to_numpy(), _packed(_matrix(pdf["v"])), low, high))
    return pd.DataFrame({"cell": [key[0]], "block": [int(key[1])], "block_data": [data]})


def _router(trees: dict):
    """Cells that each anchor must visit for one of its windows, apart from those of its own length without a tree."""

    def route(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            for size, own in pdf.groupby(pdf["v"].map(len)):
                if size not in trees:
                    found = [(0, np.arange(len(own)))]
                else:
                    width = int(own["lows"].map(len).max())
                    low, high = np.full((len(own), width), float(_ANY)), np.full((len(own), width), -float(_ANY))
                    for i, (lows, highs) in enumerate(zip(own["lows"], own["highs"])):
                        low[i, : len(lows)], high[i, : len(highs)] = lows, highs
                    found = visits(trees[size], _matrix(own["v"]), low, high)
                for leaf, at in found:
                    part = own.iloc[at].assign(cell=f"{size}/{leaf}")
                    yield pa.RecordBatch.from_pandas(part, schema=_ROUTED, preserve_index=False)

    return route


_ROUTED = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.int64())), ("lows", pa.list_(pa.int64())), ("highs", pa.list_(pa.int64())), ("home", pa.string()), ("cell", pa.string())]
)


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the best ``k`` allowed scores of each row; of equal ones those to the left."""
    worst = np.iinfo(np.int64).min
    if scores.shape[1] > k:
        masked = np.where(allowed, scores, worst)
        allowed = allowed & (scores >= np.partition(masked, -k, axis=1)[:, -k, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort([column, ~scores[row, column], row])
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def compare(chunk: tuple, block: tuple, same: bool, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, window, partner, score) of the best ``k`` partners in each window, leaf by leaf."""
    tree, leaves, ids, labels, rows = chunk
    anchors, own_labels, vectors, low, high = block
    for leaf, at in visits(tree, vectors.astype(np.int64), low, high):
        there = leaves[leaf]
        scores = products(vectors[at], rows[there])
        fits = (own_labels[at, None] == labels[None, there]) == same
        fits &= anchors[at, None] != ids[None, there]
        for w in range(low.shape[1]):
            inside = fits & (scores >= low[at, w, None]) & (scores <= high[at, w, None])
            some = np.flatnonzero(inside.any(axis=1))
            if len(some):
                row, column = _best(scores[some], inside[some], k)
                yield anchors[at[some[row]]], np.full(len(row), w), ids[there[column]], scores[some[row], column]


def _comparer(same: bool, k: int):
    def run(batches):
        for batch in batches:
            known = {}
            for chunk_data, block_data in zip(batch.column("chunk_data"), batch.column("block_data")):
                name = chunk_data.as_buffer().address
                if name not in known:
                    known = {name: pickle.loads(chunk_data.as_buffer())}
                for found in compare(known[name], pickle.loads(block_data.as_buffer()), same, k):
                    arrays = [pa.array(x, pa.int64()) for x in found]
                    yield pa.RecordBatch.from_arrays(arrays, ["anchor_id", "window", "vec_id", "score"])

    return run


def _parts(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / _SIDE)))


def _search(routed: DataFrame, chunks: DataFrame, in_cells: DataFrame, same: bool, k: int) -> DataFrame:
    """``anchor_id, window, vec_id, score`` of the best ``k`` of each window, among the cells that the anchors visit."""
    spark = routed.sparkSession
    n = partitions(spark)
    routed = stage(routed)
    blocks = F.ceil(F.count("*") / BLOCK).alias("blocks")
    # a row per cell, of which the trees have a bounded number
    sides = in_cells.join(F.broadcast(routed.groupBy("cell").agg(blocks)), "cell")
    sides = stage(sides)
    dealt = routed.join(F.broadcast(sides), "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    packed = dealt.groupBy("cell", "block").applyInPandas(_pack_block, "cell string, block long, block_data binary")
    left = chunks.join(F.broadcast(sides), "cell").select("cell", F.floor(F.col("chunk") / _SIDE).alias("c"), _parts("blocks").alias("b"), "chunk_data")
    right = packed.join(F.broadcast(sides), "cell").select("cell", _parts("chunks").alias("c"), F.floor(F.col("block") / _SIDE).alias("b"), "block_data")
    on = ["cell", "c", "b"]
    pairs = left.repartition(n, *on).join(right.repartition(n, *on), on).select("chunk_data", "block_data")
    found = pairs.mapInArrow(_comparer(same, k), "anchor_id long, window long, vec_id long, score long")
    return stage(_top(found, k).drop("place"))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def fit(points: DataFrame, count: int) -> dict:
    """Upper trees by length of the vectors, of a sample of at most about ``SAMPLE`` distinct ones."""
    wanted = min(SAMPLE, max(_LEAST, count // _ROWS_A_SAMPLE))
    share = F.pmod(F.xxhash64("vec_id", "v"), F.lit(2**40)) < F.lit(int(2**40 * min(1.0, wanted / max(count, 1))))
    sample = points.where(share).select("v").distinct().limit(2 * SAMPLE).toPandas()["v"]
    trees = {}
    for size, own in sample.groupby(sample.map(len)):
        rows = _matrix(own)
        rows = rows[np.lexsort(rows.T)]
        trees[int(size)] = grow(rows, _LEAST, np.random.default_rng(int(size)))[0]
    return trees


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank``.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``. The positives of
    an anchor are its best rows of the same label; to each belong the best rows
    of other labels with ``low * p <= 100 * score <= high * p``.
    """
    spark = vectors.sparkSession
    ship(spark)
    numbers = F.col("embedding").cast("array<double>")
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & ~bad)
    whole = F.transform(numbers, lambda x: F.floor(x * scale).cast("long"))
    points = stage(
        good.select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
            whole.alias("v"), is_anchor.alias("anchor"),
        )
    )
    trees = fit(points, points.count())
    points = stage(points.withColumn("cell", F.pandas_udf(_dealer(trees), "string")("v")))
    in_cells = stage(points.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")))
    dealt = points.join(F.broadcast(in_cells), "cell")  # a row per cell
    dealt = dealt.select("cell", F.pmod(F.xxhash64("row"), F.col("chunks")).alias("chunk"), "vec_id", "label", "v")
    chunks = stage(dealt.groupBy("cell", "chunk").applyInPandas(_packer(trees), _CHUNK_SCHEMA))

    told = chunks.select(F.explode("told").alias("t")).select("t.*").groupBy("size", "split", "child", "point")
    told = told.agg(F.min("near"), F.max("far"), F.min("thin"), F.max("thick")).toPandas()  # bounded by the splits of the trees
    known: dict[int, dict[int, list]] = {}
    for size, *found in told.itertuples(index=False):
        known.setdefault(int(size), {}).setdefault(int(found[0]), []).append((int(found[0]), int(found[1]), int(found[2]), *found[3:]))
    for size, tree in trees.items():
        fill(tree, known.get(size, {}))

    one = F.min(F.struct("label", "v", "cell")).alias("one")
    anchors = stage(points.where("anchor").groupBy("vec_id").agg(one).select("vec_id", "one.label", "one.v", F.col("one.cell").alias("home")))
    routed = "vec_id long, label long, v array<long>, lows array<long>, highs array<long>, home string, cell string"

    def windowed(lows: Column, highs: Column, frame: DataFrame) -> DataFrame:
        return frame.select("vec_id", "label", "v", lows.alias("lows"), highs.alias("highs"), "home")

    everything = F.array(F.lit(-_ANY).cast("long")), F.array(F.lit(_ANY).cast("long"))
    at_home = windowed(*everything, anchors).withColumn("cell", F.col("home"))
    near = _search(at_home, chunks, in_cells, True, positives)
    bounds = near.groupBy("anchor_id").agg(F.when(F.count("*") >= positives, F.min("score")).alias("bound"))
    bounded = anchors.join(bounds, anchors["vec_id"] == bounds["anchor_id"], "left")
    bounded = windowed(F.array(F.coalesce("bound", F.lit(-_ANY).cast("long"))), everything[1], bounded)
    away = bounded.mapInArrow(_router(trees), routed).where("cell <> home")
    placed = _top(near.unionByName(_search(away, chunks, in_cells, True, positives)), positives)
    chosen = stage(placed.select("anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # windows in the order of the positives: lowest and highest whole scores inside
    listed = F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("listed")
    windows = chosen.groupBy("anchor_id").agg(listed)  # at most ``positives`` a group
    p = F.col("listed.positive_score")
    lows = F.transform(p, lambda x: -F.floor(-x * low / 100))
    highs = F.transform(p, lambda x: F.floor(x * high / 100))
    opened = windowed(lows, highs, anchors.join(windows, anchors["vec_id"] == windows["anchor_id"]))
    found = _top(_search(opened.mapInArrow(_router(trees), routed), chunks, in_cells, False, negatives), negatives)
    found = found.select("anchor_id", (F.col("window") + 1).alias("place"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("place").alias("rank"))
    return found.join(chosen, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score", F.col("place").cast("int").alias("positive_rank")
    )
