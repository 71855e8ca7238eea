"""Jaccard self-join of word shingles by parity sketches.

Shingles hash to 64 bits. In a size band, they fall into parts, and each part
keeps the exclusive or of its shingles: two sets differ in at most as many
parts as their symmetric difference has shingles, which the threshold bounds
by D for their sizes. So of each set's parts, put in an order that depends on
their content alone (many shingles first), the first D + 1 hold one that both
sets have in common, and a join on parts finds every pair. A set takes part in
the band of its own size and, if near enough to the lower edge, in the one
below.

Candidates are verified by exact intersections. Equal sets are one node. In
each common part, members are first compared with the smallest or largest node
only; pairs that this leaves in different components are then compared in
blocks by one-bit parity sketches, whose Hamming distance is a lower bound as
well, and those within the bound are verified. So no group of copies is
expanded into pairs, and no link between components is missed.

Defined cases: texts that are null or have no words have an empty set and link
with nothing; fewer words than a shingle form one shingle; repeated rows are
equal sets; a null id never becomes a component's id while another is there;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens, words
from .common import release, ship, stage, text_slices
from .components import components
from .words import hashed, mixed, windows

_RATIO = 3
_SPARE = 1.2
_BLOCK = 1024
_BITMAP = 1 << 24
_FIRST = 16


@dataclass(frozen=True)
class Rule:
    """Link when ``whole * intersection >= part * union`` of shingles of ``size`` words."""

    size: int = 5
    part: int = 80
    whole: int = 100

    def __post_init__(self) -> None:
        # a partner lies at most one band of sizes up
        if not 0 < self.part <= self.whole or self.part * _RATIO < self.whole:
            raise ValueError(f"similarity of {self.part} / {self.whole}: a third or more is needed, and no more than all")

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes. Words: runs free of ASCII white space, A-Z lowered."""
        words = hashed((text or "").encode().lower().split())
        if not len(words):
            return words
        return np.unique(mixed(windows(words, min(self.size, len(words)))))

    def difference(self, a: int, b: int) -> int:
        """Most shingles in which linked sets of these sizes can differ."""
        return (a + b) * (self.whole - self.part) // (self.whole + self.part)

    def partner(self, size: int) -> int:
        return size * self.whole // self.part

    def bands(self, size: int):
        """(band, parts, parts to emit) for a set of this size."""
        band = 0
        while _RATIO ** (band + 1) <= size:
            band += 1
        edge = _RATIO**band - 1
        yield band, self._parts(band), self.difference(size, self.partner(size)) + 1
        if band and size <= self.partner(edge):
            yield band - 1, self._parts(band - 1), self.difference(size, edge) + 1

    def _parts(self, band: int) -> int:
        largest = _RATIO ** (band + 1) - 1
        return math.ceil(_SPARE * (self.difference(largest, self.partner(largest)) + 1))

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the parts that a set emits."""
        out = []
        for band, parts, emitted in self.bands(len(shingles)):
            part = ((shingles >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
            count = np.bincount(part, minlength=parts)
            order = np.argsort(part, kind="stable")
            held = np.flatnonzero(count)
            value = np.zeros(parts, dtype=np.uint64)
            value[held] = np.bitwise_xor.reduceat(shingles[order], np.concatenate(([0], np.cumsum(count[held])[:-1])))
            key = mixed(value ^ mixed(np.arange(parts, dtype=np.uint64) + np.uint64(band << 40)))
            chosen = np.lexsort((key, -count))[:emitted]
            out.append(key[chosen])
        return np.concatenate(out).view(np.int64)


def bits(shingles: np.ndarray) -> np.ndarray:
    """One-bit parity sketch of four to eight bits a shingle, a power of two and 64 at least."""
    size = max(64, 1 << (4 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch with fewer bits: halves laid over each other."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def digest(shingles: np.ndarray) -> tuple[int, int]:
    import xxhash

    found = xxhash.xxh3_128_intdigest(shingles.tobytes())
    signed = np.array([found >> 64, found & (2**64 - 1)], dtype=np.uint64).view(np.int64)
    return int(signed[0]), int(signed[1])


_SKETCHED = "doc_id long, row_hash long, n_shingles long, d1 long, d2 long, keys array<long>"
_SETS = "d1 long, d2 long, shingles array<long>, bits binary"


def _sketcher(rule: Rule):
    def sketch(batches):
        tokens.forget()
        for batch in batches:
            for part in text_slices(batch, 2):
                n, d1, d2, keys = [], [], [], []
                for text in part.column(2).to_pylist():
                    shingles = rule.shingles(text)
                    own = digest(shingles)
                    n.append(len(shingles))
                    d1.append(own[0])
                    d2.append(own[1])
                    keys.append(rule.keys(shingles) if len(shingles) else np.empty(0, dtype=np.int64))
                columns = [part.column(0), part.column(1), *(pa.array(x, pa.int64()) for x in (n, d1, d2)), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SKETCHED.split(", ")])
        words.forget()
        release()

    return sketch


def _set_maker(rule: Rule, wanted):
    def make(batches):
        tokens.forget()
        there = wanted.value
        for batch in batches:
            place = batch.column(0).to_numpy(zero_copy_only=False)
            chosen = np.flatnonzero(there[place >> 3] >> (place & 7) & 1)
            for part in text_slices(batch.take(pa.array(chosen)), 1):
                sets = [rule.shingles(t) for t in part.column(1).to_pylist()]
                own = [digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in own], pa.int64()), pa.array([d for _, d in own], pa.int64()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                        pa.array([bits(s).tobytes() for s in sets], pa.binary()),
                    ],
                    names=["d1", "d2", "shingles", "bits"],
                )
        words.forget()
        release()

    return make


def _row_hash():
    return F.xxhash64("doc_id", "text")


def _place(value: Column) -> Column:
    return F.pmod(value, F.lit(_BITMAP)) + 1  # Spark's bitmaps count from 1


def _marks(hashes: DataFrame, value: Column, free: str = "_") -> DataFrame:
    """A bitmap of fixed size of places, in rows: it only saves work, so a full one does no harm."""
    place = _place(value)
    return hashes.groupBy(F.bitmap_bucket_number(place).alias(f"{free}n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(f"{free}b"))


def _split(df: DataFrame, value: Column, marks: DataFrame, free: str = "_") -> tuple[DataFrame, DataFrame]:
    """Rows whose place is marked, and the rest, which hold no value of the marked ones; neither is shuffled."""
    place = _place(value)
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(f"{free}b", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.bit_get(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    looked_up = df.join(F.broadcast(marks), F.bitmap_bucket_number(place) == F.col(f"{free}n"), "left")
    return looked_up.where(marked).select(*df.columns), looked_up.where(~marked).select(*df.columns)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    out = np.zeros(_BITMAP // 8 + 4096, dtype=np.uint8)
    for n, b in _marks(hashes, F.col("row_hash")).collect():
        out[(n - 1) * 4096 : n * 4096] = np.frombuffer(bytes(b), dtype=np.uint8)
    return out


def _near(rows: list, rule: Rule):
    """Pairs of different components among the rows of a block pair whose sketches are near enough.

    A pair that meets in a smaller part as well, as the first parts of both
    tell, is left to that: what its sketches refuse there does not link.
    """
    side = np.array([r["side"] for r in rows])
    comp = np.array([r["root"] for r in rows])
    node = np.array([r["node"] for r in rows])
    n = np.array([r["n"] for r in rows])
    kinds, counts = np.unique(comp, return_counts=True)
    major = kinds[counts.argmax()]
    words = min(len(r["bits"]) for r in rows) // 8
    sketch = np.stack([folded(np.frombuffer(r["bits"], dtype=np.uint64), words) for r in rows])
    key = rows[0]["key"]
    smaller = np.full((len(rows), _FIRST), key, dtype=np.int64)  # the part itself stands for none
    for place, r in enumerate(rows):
        own = [k for k in r["firsts"] if k < key]
        smaller[place, : len(own)] = own
    for i in np.flatnonzero(comp != major):
        other = (comp != comp[i]) & ((side == 2) | (side != side[i]))
        other &= (comp == major) | (node > node[i])
        at = np.flatnonzero(other)
        if not len(at):
            continue
        low, high = np.minimum(n[at], n[i]), np.maximum(n[at], n[i])
        most = (low + high) * (rule.whole - rule.part) // (rule.whole + rule.part)
        apart = np.bitwise_count(sketch[at] ^ sketch[i]).sum(axis=1)
        at = at[(apart <= most) & (high * rule.part <= low * rule.whole)]
        at = at[~np.isin(smaller[at], smaller[i][smaller[i] < key]).any(axis=1)]
        for j in at:
            yield int(min(node[i], node[j])), int(max(node[i], node[j]))


def _comparer(rule: Rule):
    names = ("key", "x", "y", "side", "node", "root", "n", "bits", "firsts")

    def compare(batches):
        held, at = [], None
        found = set()

        def flush():
            pairs = sorted(found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                row = dict(zip(names, row))
                if at != (row["key"], row["x"], row["y"]):
                    if len(held) > 1:
                        found.update(_near(held, rule))
                    held, at = [], (row["key"], row["x"], row["y"])
                held.append(row)
            if len(found) > 100_000:
                yield flush()
        if len(held) > 1:
            found.update(_near(held, rule))
        yield flush()

    return compare


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``(a, b)`` whose sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
    common = F.size(F.array_intersect("_a", "_b")).cast("long")
    union = F.size("_a") + F.size("_b") - common
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(common * rule.whole >= union * rule.part).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _representatives(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of each set. Only rows that may be copies are shuffled with their keys."""
    filled = rows.where("n_shingles > 0")
    copies = stage(filled.select("row", "d1", "d2").join(classes.select("d1", "d2", "node"), ["d1", "d2"]).where("row <> node").select("row"))
    some, others = _split(filled, F.xxhash64("row"), _marks(copies, F.xxhash64("row")))
    return others.unionByName(some.join(copies, "row", "left_anti"))


def _open_keys(rooted: DataFrame) -> DataFrame:
    """``key, g``: parts whose ``g`` members lie in several components; of parts with the same members, one."""
    members = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"_m{salt}") for salt in (0, 1)]
    sizes = F.count(F.lit(1)).alias("g"), F.min("root").alias("_l"), F.max("root").alias("_h")
    found = rooted.groupBy("key").agg(*sizes, *members).where("_l <> _h")
    return found.groupBy("g", "_m0", "_m1").agg(F.min("key").alias("key")).select("key", "g")


def link(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, row_hash, n_shingles, d1, d2, row`` of all documents, and classes of equal sets
    ``d1, d2, first_id, root`` where classes of one component share a root."""
    spark = docs.sparkSession
    ship(spark)
    read = docs.select("doc_id", _row_hash().alias("row_hash"), "text")
    rows = stage(read.mapInArrow(_sketcher(rule), _SKETCHED).withColumn("row", F.monotonically_increasing_id()))
    classes = rows.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"))
    classes = stage(classes)

    parts = _representatives(rows, classes).select(F.col("row").alias("node"), F.explode("keys").alias("key"))
    shared = parts.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = stage(parts.join(shared, "key"))

    nodes = members.select("node").distinct().join(rows.select(F.col("row").alias("node"), "row_hash", "d1", "d2", F.col("n_shingles").alias("n")), "node")
    nodes = stage(nodes)
    wanted = spark.sparkContext.broadcast(_bitmap(nodes))
    placed = docs.select(F.pmod(_row_hash(), F.lit(_BITMAP)).alias("place"), "text")
    made = placed.mapInArrow(_set_maker(rule, wanted), _SETS)
    sets = stage(nodes.select("node", "d1", "d2", "n").join(made.dropDuplicates(["d1", "d2"]), ["d1", "d2"]).drop("d1", "d2"))

    center = F.when(F.pmod("key", F.lit(2)) == 0, F.col("low")).otherwise(F.col("high"))
    first = members.select("node", center.alias("center")).where("node <> center")
    first = first.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()
    links = stage(_verified(first, sets, rule))
    roots = components(links)

    rooted = members.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    chosen = stage(rooted.join(_open_keys(rooted), "key"))
    firsts = chosen.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, _FIRST).alias("firsts"))
    blocks = F.ceil(F.col("g") / _BLOCK).cast("int")
    left = (
        chosen.withColumn("_own", F.pmod(F.xxhash64("node", "key"), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key", "node", "root", F.least("_own", "_other").alias("x"), F.greatest("_own", "_other").alias("y"),
            F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("side"),
        )
        .join(sets.select("node", "n", "bits").join(firsts, "node"), "node")
    )
    dealt = left.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    more = stage(dealt.mapInArrow(_comparer(rule), "a long, b long").distinct())
    ends = F.xxhash64("node")
    named, _ = _split(sets, ends, _marks(more.select(F.explode(F.array("a", "b")).alias("node")), ends))
    links = stage(links.unionByName(_verified(more, named, rule)))
    classes = classes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")
    return rows.drop("keys"), classes


def components_of(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, row_hash, n_shingles, component_id, row`` of every document; the id is the smallest in its component."""
    rows, classes = link(docs, rule)
    names = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = classes.join(names, "root").select("d1", "d2", "root", "component_id")
    out = rows.join(named, ["d1", "d2"], "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "row_hash", "n_shingles", "component_id", "row", "root")


def keep_first(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One document of each component, that with the smallest id (then text hash), with all its columns.

    Rows without shingles all stay. Of repeated rows one stays: copies of the
    kept row are told apart by a row number among rows of the same id and text.
    """
    found = components_of(docs, rule).where("n_shingles > 0")
    keyed = [F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("none"), F.col("row_hash").alias("h")]
    keys = found.groupBy("root", *keyed).agg(F.count(F.lit(1)).alias("rows"))
    best = keys.groupBy("root").agg(F.min(F.struct("none", "i", "h")).alias("best"))
    first = F.struct("none", "i", "h") == F.col("best")
    # what goes, and what stays once; texts of documents that are surely neither need not travel
    others = stage(keys.join(best, "root").where(~first | (F.col("rows") > 1)).select("i", "none", "h", first.alias("again")))
    free = "_"  # no column starts with it, whatever the columns of docs are
    while any(c.lower().startswith(free) for c in docs.columns):
        free += "_"
    names = [f"{free}{c}" for c in ("i", "none", "h")]
    own = F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), _row_hash()
    hashed_docs = docs.select("*", *(c.alias(n) for c, n in zip(own, names)))
    others = others.toDF(*names, f"{free}again")
    some, untouched = _split(hashed_docs, F.col(names[2]), _marks(others, F.col(names[2]), free), free)
    rest = some.join(others, names, "left_anti")
    once = some.join(others.where(f"{free}again"), names, "left_semi").dropDuplicates(names)
    return untouched.unionByName(rest).unionByName(once).select(*docs.columns)
