"""Exact ranks of all rows: parallel sorting by regular sampling.

Every task sorts its rows and writes them as a run. Rows at regular places of
all runs are a small sample, whose regular places again give the splitters;
rows between two splitters are exchanged to one segment and sorted there, and
the counts of the segments before give each row its rank. Ties go by the run
and the place in it, so rows that repeat a key as often as one likes are
spread over segments like others.

The sample has about ``_EACH`` rows a segment, and the number of segments
follows the shuffle partitions of the session, so what the driver sorts does
not grow with the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, ship, stage

_EACH = 32
_PLACES = 2**33


def _segmenter(splitters: list[np.ndarray]):
    """Number of splitters that come before or at each row, by all keys in turn."""

    def segments(*keys: pd.Series) -> pd.Series:
        rows = [np.concatenate([s, k.to_numpy(dtype=np.int64)]) for s, k in zip(splitters, keys)]
        m = len(splitters[0])
        order = np.lexsort([np.arange(len(rows[0])), *reversed(rows)])  # of equal ones, splitters come first
        passed = np.empty(len(order), dtype=np.int32)
        passed[order] = np.cumsum(order < m)
        return pd.Series(passed[m:])

    return segments


def ranked(rows: DataFrame, keys: list[Column], eligible: Column) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... of eligible rows by ``keys`` (whole numbers, ascending, never null); null for the others.

    Columns of ``rows`` must not be named ``rank``, ``segment``, ``run``, ``place``, ``enters`` or ``key<i>``.
    """
    spark = rows.sparkSession
    ship(spark)
    names = [f"key{i}" for i in range(len(keys))]
    columns = rows.columns
    keyed = rows.select(*columns, F.coalesce(eligible, F.lit(False)).alias("enters"), *[k.cast("long").alias(n) for k, n in zip(keys, names)])
    runs = keyed.sortWithinPartitions(F.desc("enters"), *names)
    runs = stage(runs.select("*", F.spark_partition_id().cast("long").alias("run"), (F.monotonically_increasing_id() % _PLACES).alias("place")))
    entered, order = runs.where("enters"), [*names, "run", "place"]
    count = entered.count()
    segments = 4 * partitions(spark)
    distance = max(1, count // (_EACH * segments))
    regular = entered.where(F.pmod(F.col("place") + F.pmod(F.xxhash64("run"), F.lit(distance)), F.lit(distance)) == 0)
    sample = regular.select(*order).toPandas().sort_values(order, ignore_index=True)
    cuts = sample.iloc[np.unique(np.arange(1, segments) * len(sample) // segments)] if len(sample) else sample
    cut = F.pandas_udf(_segmenter([cuts[n].to_numpy(dtype=np.int64) for n in order]), "int")
    dealt = entered.withColumn("segment", cut(*order))
    sizes = dealt.groupBy("segment").count().toPandas().sort_values("segment", ignore_index=True)
    sizes["before"] = sizes["count"].cumsum() - sizes["count"]
    before = spark.createDataFrame(sizes[["segment", "before"]].astype("int64"), "segment int, before long")
    within = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    placed = dealt.select(*columns, "segment", within.alias("within")).join(F.broadcast(before), "segment")  # a row a segment
    placed = placed.select(*columns, (F.col("before") + F.col("within")).alias("rank"))
    return placed.unionByName(runs.where("NOT enters").select(*columns, F.lit(None).cast("long").alias("rank")))
