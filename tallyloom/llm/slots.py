"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Rows hash into a fixed number of slots. Only bytes and rows per slot reach the
driver, so what it holds is bounded by the number of slots. The map from slots
to shards is stored in versions; rebalancing edits the latest one, moving or
exchanging as few slots as make the shards' bytes nearly equal.

Defined cases: a null text has no bytes; null ids spread by their text;
repeated rows count one by one; an empty table gives an empty result and the
map of version 1; further columns are not touched, and none may be missing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 16_384
_MAP = "virtual_slot int, shard int, bytes long, rows long, first_position long"


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def slotted(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, size, checksum and virtual slot."""
    text = F.col(text_col)
    narrow = docs.select(
        F.col(id_col),
        text_size(text).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    key = F.xxhash64(F.col(id_col), F.col("text_crc32"), F.col("size"))
    return narrow.withColumn("virtual_slot", F.pmod(key, F.lit(slots)).cast("int"))


def even_map(slots: int, shards: int) -> np.ndarray:
    """Version 1: slots dealt in turn, before any bytes are known."""
    return (np.arange(slots) % shards).astype(np.int64)


def rebalance(owner: np.ndarray, slot_bytes: np.ndarray, shards: int) -> np.ndarray:
    """The map with slots moved from the fullest to the emptiest shard, or exchanged, while that narrows their gap."""
    owner, load = owner.copy(), np.bincount(owner, weights=slot_bytes, minlength=shards)
    while True:
        full, lean = int(load.argmax()), int(load.argmin())
        gap = load[full] - load[lean]
        of_full = np.flatnonzero((owner == full) & (slot_bytes > 0))
        of_lean = np.flatnonzero((owner == lean) & (slot_bytes > 0))
        if not len(of_full) or gap <= 1:
            return owner
        give = slot_bytes[of_full]
        take = np.concatenate(([0], np.sort(slot_bytes[of_lean])))
        back = np.searchsorted(take, give - gap / 2).clip(0, len(take) - 1)
        best = None
        for at in (back, (back - 1).clip(0)):
            moved = give - take[at]
            left = np.where((moved > 0) & (moved < gap), np.abs(gap - 2 * moved), np.inf)
            k = int(left.argmin())
            if np.isfinite(left[k]) and (best is None or left[k] < best[0]):
                best = (left[k], of_full[k], take[at][k], moved[k])
        if best is None:
            return owner
        _, slot, size, moved = best
        owner[slot] = lean
        if size:
            owner[of_lean[np.flatnonzero(slot_bytes[of_lean] == size)[0]]] = full
        load[full] -= moved
        load[lean] += moved


def save_map(spark: SparkSession, folder: str, version: int, owner: np.ndarray, size: np.ndarray, rows: np.ndarray) -> None:
    """Store a version, with each slot's bytes, rows and the first position of its rows within the shard."""
    first = np.zeros(len(owner), dtype=np.int64)
    for shard in np.unique(owner):
        mine = np.flatnonzero(owner == shard)
        first[mine] = np.concatenate(([0], np.cumsum(rows[mine])[:-1]))
    data = list(zip(range(len(owner)), owner.tolist(), size.tolist(), rows.tolist(), first.tolist()))
    spark.createDataFrame(data, _MAP).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/map_version={version}")


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(_MAP).parquet(f"{folder}/map_version={version}").withColumn("map_version", F.lit(version))


def shard_by_slots(docs: DataFrame, folder: str, shards: int = 24, slots: int = SLOTS) -> DataFrame:
    """Assign every row a shard with nearly equal bytes and a gapless position in it.

    ``folder`` receives versions 1 (even) and 2 (rebalanced) of the map. The
    join broadcasts ``slots`` rows. Positions add a row number within the slot
    to the slot's first position, so no task holds a whole shard.
    """
    spark = docs.sparkSession
    rows = slotted(docs, slots)
    size, count = np.zeros(slots), np.zeros(slots, dtype=np.int64)
    for slot, b, n in rows.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect():
        size[slot], count[slot] = b, n
    owner = even_map(slots, shards)
    save_map(spark, folder, 1, owner, size.astype(np.int64), count)
    save_map(spark, folder, 2, rebalance(owner, size, shards), size.astype(np.int64), count)
    where = load_map(spark, folder, 2).select("virtual_slot", "shard", "first_position", "map_version")
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_n", F.row_number().over(order))
        .join(F.broadcast(where), "virtual_slot")
        .withColumn("position", F.col("first_position") + F.col("_n") - 1)
        .drop("_n", "first_position")
    )
