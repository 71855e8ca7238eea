"""Token ids as length-delimited binary records with an offset index beside them.

A record is: length of the payload (unsigned 64 bit), masked checksum of these
eight bytes, payload, masked checksum of the payload; all little-endian. The
checksum is CRC-32, turned right by 15 bits plus a constant, so that data
holding checksums keeps its own intact. The payload holds a presence byte for
the id, the bytes per token (2 where all ids of the sequence fit, else 4), the
id, the number of tokens and the tokens (unsigned).

Each task writes one file under a name of its own attempt; the index is a
table that Spark commits, so files of lost attempts are never referred to.

Defined cases: a null text is an empty one; a null id comes first; rows with
equal ids follow each other by their text's checksum; an empty table gives no
file and an empty index; further columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_folder, open_store, partitions, ship, stage
from .tokens import coder, slices

_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<BBqI")
_CRC = struct.Struct("<I")
_SPAN = 8 << 20

INDEX = "file_no int, file string, offset long, length long, doc_id long, n_tokens long, start_in_file long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, _CRC.pack(masked(size)), payload, _CRC.pack(masked(payload))))


def unframe(data: bytes) -> bytes:
    """Payload of one framed record; raises ValueError on any damage."""
    if len(data) < 16:
        raise ValueError("record is cut short")
    size, crc = _HEAD.unpack_from(data)
    if masked(data[:8]) != crc:
        raise ValueError("length checksum differs")
    if size != len(data) - 16:
        raise ValueError("record length differs")
    payload = data[12:-4]
    if masked(payload) != _CRC.unpack(data[-4:])[0]:
        raise ValueError("payload checksum differs")
    return payload


def pack(doc_id: int | None, ids: bytes) -> bytes:
    """Payload of a sequence, given as unsigned 32-bit ids."""
    tokens = np.frombuffer(ids, dtype="<u4")
    width = 2 if not len(tokens) or tokens.max() < 1 << 16 else 4
    return _BODY.pack(doc_id is not None, width, doc_id or 0, len(tokens)) + tokens.astype(f"<u{width}").tobytes()


def unpack(payload: bytes) -> tuple[int | None, bytes]:
    """Id and unsigned 32-bit tokens of a payload."""
    there, width, doc_id, n = _BODY.unpack_from(payload)
    if width not in (2, 4) or len(payload) != _BODY.size + width * n:
        raise ValueError("token count differs")
    tokens = np.frombuffer(payload, dtype=f"<u{width}", offset=_BODY.size)
    return (doc_id if there else None), tokens.astype("<u4").tobytes()


def _writer(folder: str, vocabulary: str, keeps_space: bool, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches):
        number, out, begin, start = TaskContext.get().partitionId(), None, 0, 0
        store, base = open_store(folder)
        name = f"part-{number:06d}-{uuid.uuid4().hex}.rec"
        try:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for a, b in slices(texts):
                    if out is None:
                        store.create_dir(base, recursive=True)
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    framed, rows = [], []
                    for key, ids in zip(keys[a:b], coder(vocabulary, keeps_space).encode(texts[a:b])):
                        ids += end
                        record = frame(pack(key, ids))
                        rows.append((begin, len(record), key, len(ids) // 4, start))
                        framed.append(record)
                        begin += len(record)
                        start += len(ids) // 4
                    out.write(b"".join(framed))
                    at, size, key, n, first = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number] * len(rows), pa.int32()),
                            pa.array([name] * len(rows), pa.string()),
                            *(pa.array(x, pa.int64()) for x in (at, size, key, n, first)),
                        ],
                        names=["file_no", "file", "offset", "length", "doc_id", "n_tokens", "start_in_file"],
                    )
        finally:
            if out is not None:
                out.close()

    return write


def write_records(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, keeps_space: bool = False) -> tuple[str, DataFrame]:
    """Encode and write all documents in ascending order of their id; returns the folder and its index.

    Rows are dealt by ranges of the id, so file numbers follow the ids; text
    is shuffled once and encoded where it is written.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or fresh_folder(spark, "records")
    rows = docs.select("doc_id", F.col("text").alias("text")).withColumn("_tie", F.crc32("text"))
    dealt = rows.repartitionByRange(partitions(spark), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    index = dealt.drop("_tie").mapInArrow(_writer(folder, vocabulary, keeps_space, end_id), INDEX)
    return folder, stage(index)


def _spans(offsets: np.ndarray, lengths: np.ndarray):
    """Runs of sorted records that touch, as (first, last + 1), each up to a span long or one record."""
    begin = 0
    for i in range(1, len(offsets) + 1):
        if i == len(offsets) or offsets[i] != offsets[i - 1] + lengths[i - 1] or offsets[i] + lengths[i] - offsets[begin] > _SPAN:
            yield begin, i
            begin = i


def _reader(folder: str, keep_ids: bool):
    def read(batches):
        store, base = open_store(folder)
        name, source = None, None
        try:
            for batch in batches:
                files = batch.column(1).to_pylist()
                at, size, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 6))
                order = sorted(range(len(files)), key=lambda i: (files[i], at[i]))
                cuts = [0, *(i for i in range(1, len(order)) if files[order[i]] != files[order[i - 1]]), len(order)]
                for lo, hi in zip(cuts, cuts[1:]):
                    if lo == hi:
                        continue
                    mine = order[lo:hi]
                    if files[mine[0]] != name:
                        if source is not None:
                            source.close()
                        name, source = files[mine[0]], store.open_input_file(f"{base}/{files[mine[0]]}")
                    for a, b in _spans(at[mine], size[mine]):
                        span = mine[a:b]
                        first = int(at[span[0]])
                        data = source.read_at(int(at[span[-1]] + size[span[-1]]) - first, first)
                        found = [unpack(unframe(data[at[i] - first : at[i] - first + size[i]])) for i in span]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([number for number in batch.column(0).take(pa.array(span)).to_pylist()], pa.int32()),
                                pa.array([k for k, _ in found], pa.int64()),
                                pa.array(start[span], pa.int64()),
                                pa.array([len(x) // 4 for _, x in found], pa.int64()),
                                pa.array([zlib.crc32(x) for _, x in found], pa.int64()),
                                *([pa.array([x for _, x in found], pa.binary())] if keep_ids else []),
                            ],
                            names=["file_no", "doc_id", "start_in_file", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])],
                        )
        finally:
            if source is not None:
                source.close()

    return read


def read_records(folder: str, index: DataFrame, keep_ids: bool = True) -> DataFrame:
    """Read the records an index names, in any order: rows are sorted per batch and touching records read at once."""
    ship(index.sparkSession)
    schema = "file_no int, doc_id long, start_in_file long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return index.mapInArrow(_reader(folder, keep_ids), schema)


def file_starts(index: DataFrame) -> DataFrame:
    """Tokens before each file: one row per file, so as many as there were partitions."""
    totals = index.groupBy("file_no").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("file_start"))


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int, keep_ids: bool = False) -> DataFrame:
    """Write all documents, read all files back, and give each document its place among all tokens."""
    folder, index = write_records(docs, vocabulary, end_id)
    back = read_records(folder, index, keep_ids).join(F.broadcast(file_starts(index)), "file_no")
    return back.withColumn("start", F.col("file_start") + F.col("start_in_file")).drop("file_no", "file_start", "start_in_file")
