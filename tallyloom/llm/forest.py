"""Near copies among embeddings by a forest of random-projection trees with spill.

Vectors of a label are split at the median along random directions, again and
again; those near the cut go to both sides, so that a pair at the threshold is
parted by few cuts, and by all trees hardly ever. Vectors sharing a leaf are
compared exactly, in blocks, in double precision.

The upper levels of a tree are cut across tasks: a label of more than ``CELL``
vectors is dealt into cells by as many upper trees as vote below that size,
so recall does not fall with it; they are fitted on at most ``SAMPLE`` rows per
cell, by as many rounds as cells need to become small; all rows are
dealt by them. A cell goes to one task, which grows ``TREES`` lower trees in
it, down to leaves of ``LEAF``, so a vector travels once per cell and not once
per leaf. A cell that no cut makes smaller (near copies beyond number) is dealt
as pairs of blocks of ``CELL / 2``.

Equal vectors are one node with a multiplicity. A pair counts in the first
cell and leaf it shares only, so links are summed where they are found and
never listed; for components each task gives one edge per node. Recall is not
certain by construction: parted in a tree with a chance of a few hundredths at
the threshold, a pair is lost if all upper or all lower trees part it; tests
measure it. Equal
vectors are told apart by 128-bit hashes.

Defined cases: vectors that are null or zero, or hold null or non-finite
numbers, and those without a label link with nothing; vectors of different
lengths never link; a repeated row is another vector; a null id becomes a
component's id only where there is no other; an empty table gives no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, ship, stage
from .components import components

THRESHOLD = 0.98
TREES = 6
LEAF = 256
CELL = 16_384
SAMPLE = 8192
SPILL = 1.5
_DEPTH = 9
_STUCK = 0.8
_CHUNK = 20_000
_NONE = -1


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = np.asarray(vectors, dtype=np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _cut(rows: np.ndarray, rng: np.random.Generator, margin: float):
    """(direction, cut, rows left, rows right) that makes both sides smaller, or ``None``."""
    for _ in range(3):
        direction = rng.standard_normal(rows.shape[1])
        direction /= np.linalg.norm(direction)
        along = rows @ direction
        at = float(np.median(along))
        left, right = along < at + margin, along >= at - margin
        if max(left.mean(), right.mean()) <= _STUCK:
            return direction, at, left, right
    return None


def fit_cell(sample: np.ndarray, seed: int, depth: int, margin: float):
    """Nested cuts ``(direction, cut, left, right)``; ``None`` is a leaf that may be cut further, ``False`` one that may not."""
    rng = np.random.default_rng(seed)

    def cut(rows: np.ndarray, level: int):
        if level == 0 or level < depth and len(rows) < 32:  # the first cut is always tried, so rounds come to an end
            return None
        found = _cut(rows, rng, margin)
        if found is None:
            return False
        direction, at, left, right = found
        return direction, at, cut(rows[left], level - 1), cut(rows[right], level - 1)

    return cut(sample, depth)


def deal(tree, rows: np.ndarray, margin: float):
    """(path, final, row positions) of every leaf that gets rows; paths are numbered as in a heap."""
    todo = [(tree, 1, np.arange(len(rows)))]
    while todo:
        node, path, at = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, tuple):
            yield path, node is False, at
            continue
        along = rows[at] @ node[0]
        todo.append((node[2], 2 * path, at[along < node[1] + margin]))
        todo.append((node[3], 2 * path + 1, at[along >= node[1] - margin]))


def _margin(dimensions: int, threshold: float) -> float:
    """Half the spill: parts of the spread, along a random direction, of two vectors at the threshold."""
    return SPILL / 2 * np.sqrt(2 - 2 * threshold) / np.sqrt(dimensions)


def _fitter(threshold: float, limit: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = unit(np.stack(pdf["vector"].to_numpy()))
        cell, size = int(pdf["cell"].iloc[0]), int(pdf["size"].iloc[0])
        depth = min(_DEPTH, max(1, int(np.ceil(np.log2(size / limit)))))
        tree = fit_cell(rows, cell & (2**63 - 1), depth, _margin(rows.shape[1], threshold))
        return pd.DataFrame({"cell": [cell], "size": [size], "tree": [pickle.dumps(tree)]})

    return fit


def _dealer(threshold: float):
    """Deals rows that come after the row of their cell's tree."""

    def split(batches):
        tree = None
        for batch in batches:
            frame = batch.to_pandas()
            for (cell, _), own in frame.groupby(["cell", "chunk"], sort=False):
                if own["tree"].iloc[0] is not None:
                    tree, own = pickle.loads(own["tree"].iloc[0]), own.iloc[1:]
                if not len(own):
                    continue
                rows = unit(np.stack(own["vector"].to_numpy()))
                node = own["node"].to_numpy(dtype=np.int64)
                for path, final, at in deal(tree, rows, _margin(rows.shape[1], threshold)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(node[at], pa.int64()), pa.array(np.full(len(at), cell), pa.int64()),
                            pa.array(np.full(len(at), path), pa.int64()), pa.array(np.full(len(at), final), pa.bool_()),
                        ],
                        names=["node", "cell", "path", "final"],
                    )

    return split


def upper_cells(nodes: DataFrame, large: DataFrame, threshold: float, limit: int, trees: int = TREES) -> DataFrame:
    """``node, cell`` of every cell that a node of a large part lies in; ``nodes`` has ``node, part, vector``.

    Trees travel as rows, one for each ``_CHUNK`` rows of their cell, and never with each row.
    """
    roots = nodes.join(large.select("part"), "part").select("node", F.explode(F.array(*map(F.lit, range(trees)))).alias("_tree"), "part")
    rows = stage(roots.select("node", F.xxhash64("part", "_tree").alias("cell"), F.lit(False).alias("final")))
    vectors = nodes.select("node", "vector")
    done = None
    while True:
        large = stage(rows.where(~F.col("final")).groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit))
        ready = rows.join(large.select("cell"), "cell", "left_anti").select("node", "cell")
        done = ready if done is None else done.unionByName(ready)
        if large.isEmpty():
            return done
        open_rows = rows.join(large, "cell")
        rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("node", "cell"), "node"))
        sample = open_rows.withColumn("_rank", rank).where(F.col("_rank") <= SAMPLE).join(vectors, "node")
        fitted = sample.select("cell", "size", "vector").groupBy("cell").applyInPandas(_fitter(threshold, limit), "cell long, size long, tree binary")
        chunks = F.ceil(F.col("size") / _CHUNK).cast("int")
        data = open_rows.join(vectors, "node").select(
            "cell", F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"), "node", "vector", F.lit(None).cast("binary").alias("tree")
        )
        fits = stage(fitted).select(
            "cell", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(None).cast("long").alias("node"),
            F.lit(None).cast(nodes.schema["vector"].dataType).alias("vector"), "tree",
        )
        both = data.unionByName(fits).repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", F.col("tree").isNull())
        dealt = both.mapInArrow(_dealer(threshold), "node long, cell long, path long, final boolean")
        rows = stage(dealt.select("node", F.xxhash64("cell", "path").alias("cell"), "final"))


def lower_leaves(rows: np.ndarray, rng: np.random.Generator, margin: float, leaf: int):
    """Positions of the rows of every leaf of one tree."""
    todo = [np.arange(len(rows))]
    while todo:
        at = todo.pop()
        found = _cut(rows[at], rng, margin) if len(at) > leaf else None
        if found is None:
            yield at
        else:
            todo += [at[found[2]], at[found[3]]]


def _find(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    root = parent[at]
    while True:
        up = parent[root]
        if (up == root).all():
            return root
        root = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of each pair; the smaller position is the root."""
    while True:
        low, high = (f(_find(parent, a), _find(parent, b)) for f in (np.minimum, np.maximum))
        apart = low != high
        if not apart.any():
            return
        np.minimum.at(parent, high[apart], low[apart])


class _Seen:
    """The cells and leaves compared before, by row."""

    def __init__(self, earlier: list[np.ndarray]) -> None:
        width = max(map(len, earlier))
        self.slots = np.full((len(earlier), width + 4), _NONE, dtype=np.int64)
        self.held = np.array([len(e) for e in earlier])
        # numbers of earlier cells lie below those of leaves
        names = {c: -2 - k for k, c in enumerate(sorted({int(c) for e in earlier for c in e}))}
        for k, e in enumerate(earlier):
            self.slots[k, : len(e)] = [names[int(c)] for c in e]

    def add(self, at: np.ndarray, leaf: int) -> None:
        if self.held[at].max() == self.slots.shape[1]:
            self.slots = np.pad(self.slots, ((0, 0), (0, 8)), constant_values=_NONE)
        self.slots[at, self.held[at]] = leaf
        self.held[at] += 1

    def all_together(self, at: np.ndarray) -> bool:
        """Whether one earlier cell or leaf holds all these rows."""
        mine = self.slots[at]
        return any((mine == s).any(axis=1).all() for s in mine[0] if s != _NONE)

    def together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair, whether an earlier cell or leaf holds both."""
        out = np.empty(len(a), dtype=bool)
        width = max(1, int(max(self.held[a].max(), self.held[b].max())))
        step = max(1, 4_000_000 // width**2)
        for begin in range(0, len(a), step):
            x, y = self.slots[a[begin : begin + step], :width], self.slots[b[begin : begin + step], :width]
            out[begin : begin + step] = ((x[:, :, None] == y[:, None, :]) & (x != _NONE)[:, :, None]).any(axis=(1, 2))
        return out

    def matrix(self, at: np.ndarray) -> np.ndarray:
        """Rows by earlier cells and leaves, one where a row lies in it."""
        names, place = np.unique(self.slots[at], return_inverse=True)
        out = np.zeros((len(at), len(names)), dtype=np.float32)
        np.put_along_axis(out, place.reshape(len(at), -1), 1, axis=1)
        out[:, names == _NONE] = 0
        return out


def compare_cell(vectors: np.ndarray, times: np.ndarray, side: np.ndarray, earlier: list[np.ndarray], seed: int, threshold: float, trees: int, leaf: int):
    """Links and roots (positions) of the rows of a cell, or of a pair of its blocks.

    ``side`` 2 compares all rows, 0 and 1 only with each other; ``earlier`` names
    the cells before this one, whose pairs are counted there.
    """
    links, parent = np.zeros(len(vectors), dtype=np.int64), np.arange(len(vectors))
    seen, number = _Seen(earlier), 0
    margin = _margin(vectors.shape[1], threshold)
    for tree in range(trees):
        for at in lower_leaves(vectors, np.random.default_rng([seed, tree]), margin, leaf):
            if len(at) < 2 or number and seen.all_together(at):
                continue
            own, matrix = vectors[at], None
            step = max(32, 2_000_000 // len(at))
            for begin in range(0, len(at), step):
                i, j = np.nonzero(own[begin : begin + step] @ own.T >= threshold)
                i += begin
                keep = (i < j) & ((side[at[i]] == 2) | (side[at[i]] != side[at[j]]))
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                a, b = at[i], at[j]
                _unite(parent, a, b)
                if len(i) <= 64 * len(at):
                    new = ~seen.together(a, b)
                else:
                    matrix = seen.matrix(at) if matrix is None else matrix
                    new = (matrix[begin : begin + step] @ matrix.T)[i - begin, j] == 0
                np.add.at(links, a[new], times[b[new]])
                np.add.at(links, b[new], times[a[new]])
            seen.add(at, number)
            number += 1
    return links, _find(parent, np.arange(len(vectors)))


def _comparer(threshold: float, trees: int, leaf: int):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        cell, node = int(pdf["cell"].iloc[0]), pdf["node"].to_numpy(dtype=np.int64)
        if len(node) < 2:
            return pd.DataFrame({"node": node[:0], "links": node[:0], "root": node[:0]})
        earlier = [np.array([c for c in cells if c < cell], dtype=np.int64) for cells in pdf["cells"]]
        vectors = unit(np.stack(pdf["vector"].to_numpy()))
        links, root = compare_cell(
            vectors, pdf["times"].to_numpy(dtype=np.int64), pdf["side"].to_numpy(), earlier, cell & (2**63 - 1), threshold, trees, leaf
        )
        told = np.isin(root, root[root != np.arange(len(root))]) | (links > 0)
        return pd.DataFrame({"node": node[told], "links": links[told], "root": node[root[told]]})

    return compare


def _dealt(nodes: DataFrame, threshold: float, limit: int, trees: int) -> DataFrame:
    """``cell, x, y, side, node, times, cells, vector``: the rows of each task of the comparison."""
    # at most one row for every CELL rows of the table
    large = stage(nodes.groupBy("part").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit))
    whole = nodes if large.isEmpty() else nodes.join(large.select("part"), "part", "left_anti")
    zero = F.lit(0)
    out = whole.select(
        F.col("part").alias("cell"), zero.alias("x"), zero.alias("y"), F.lit(2).alias("side"), "node", "times", F.array("part").alias("cells"), "vector"
    )
    if large.isEmpty():
        return out
    found = stage(upper_cells(nodes, large, threshold, limit, trees))
    lists = found.groupBy("node").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    sizes = found.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.when(F.col("size") <= limit, 1).otherwise(F.ceil(F.col("size") / (limit // 2))).cast("int")
    cut = (
        found.join(sizes, "cell")
        .withColumn("_own", F.pmod(F.xxhash64("node", "cell"), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(zero, blocks - 1)))
        .join(nodes.select("node", "times", "vector").join(lists, "node"), "node")
    )
    return out.unionByName(
        cut.select(
            "cell", F.least("_own", "_other").alias("x"), F.greatest("_own", "_other").alias("y"),
            F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("side"),
            "node", "times", "cells", "vector",
        )
    )


def near_copies(embeddings: DataFrame, threshold: float = THRESHOLD, trees: int = TREES) -> DataFrame:
    """``vec_id, n_links, component_id`` of every vector."""
    spark = embeddings.sparkSession
    ship(spark)
    wrong = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~wrong & some, F.lit(False))
    key = ["_label", "_h1", "_h2", "_good"]
    rows = embeddings.select(
        "vec_id", "embedding", F.col("label").alias("_label"), good.alias("_good"),
        F.xxhash64("embedding").alias("_h1"), F.xxhash64(F.lit(1), "embedding", F.size("embedding")).alias("_h2"),
    )
    classes = rows.where("_good").groupBy(*key).agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("times"), F.first("embedding").alias("vector")
    )
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("part", F.xxhash64("_label", F.size("vector"))))
    nodes = classes.select("node", "part", "vector", "times")

    # a fixed number of parts: the work is in the comparison, not in the bytes that a coalesced part would be measured by
    tasks = _dealt(nodes, threshold, CELL, trees).repartition(partitions(spark), "cell", "x", "y")
    linked = stage(tasks.groupBy("cell", "x", "y").applyInPandas(_comparer(threshold, trees, LEAF), "node long, links long, root long"))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = classes.select(*key, "node", "first", "times").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.join(links, "node", "left")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(ids, "root").select(*key, (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id")
    out = rows.drop("embedding").join(named, key, "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("_good"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    )
