"""What the operators share: tables, shipping the package to workers, files that all machines reach."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import weakref
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import shared_dir, stage

__all__ = ["fresh_folder", "open_store", "partitions", "release", "ship", "shared_dir", "stage", "table", "text_slices"]

_shipped: weakref.WeakSet = weakref.WeakSet()
#: Bytes of texts that are worked on at once.
_SLICE = 1 << 22


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to workers by the slice.

    A batch lies in the executor and in its worker at once, up to 64 MB in
    each by Spark's default. A limit that the session sets itself stays.
    """
    limit, default = "spark.sql.execution.arrow.maxBytesPerBatch", f"{1 << 26}b"
    if spark.conf.get(limit, default) == default:
        spark.conf.set(limit, str(_SLICE))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per context, so that functions run in tasks can be imported there."""
    small_batches(spark)
    context = spark.sparkContext
    if context in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"tallyloom-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tallyloom", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context)


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name under the shared folder of the session."""
    return f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}"


def open_store(uri: str):
    """(file system, path) for a URI or an absolute path, by pyarrow's own drivers."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def text_slices(batch: pa.RecordBatch, column: int, rows: int = 512, size: int = _SLICE):
    """Slices of a batch of at most ``rows`` rows and about ``size`` bytes of that column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        passed = ends[begin - 1] if begin else 0
        end = min(max(begin + 1, int(np.searchsorted(ends, passed + size, side="right"))), begin + rows, batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def release() -> None:
    """Give memory that a worker has freed back to its machine: workers outlive their operators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
