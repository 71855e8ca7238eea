"""WARC archives written with an index first, and read back by it in coalesced byte ranges.

Every record is a gzip member of its own. While an archive is written, its
index rows (file, offset, length, URL, digest) are handed to Spark, which
commits them; files of lost attempts are in no index. Reading takes any subset
of index rows, sorts it per file, joins neighbours into ranges up to ``SPAN``
bytes, and parses the records out of each range that is read at once. Ranges
are dealt to tasks by the bytes of the archives, not by those of the index.

Record ids are UUIDs of file and offset, so they differ whatever the pages are;
the page's id stands in a field of its own. The target URI is the page's URL as
it is, except that characters a URI cannot hold are quoted; then a further field
keeps the URL.

Of pages with equal payloads of ``least`` bytes or more, that with the largest
id is a response, the others are revisits that refer to it.

Defined cases: a null payload is empty; a null id or URL is left out of the
record and comes back null; rows that share the largest id of a group are all
responses; an empty table gives no archive; further columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_folder, open_store, partitions, ship, stage

SPAN = 8 << 20
TASK_BYTES = 128 << 20
GAP = 64 << 10
LEAST = 1000
INDEX = "file_no int, file string, offset long, length long, url string, payload_digest string, page_id long, record_type string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def with_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Payload, its size and digest, and the page that a copy refers to.

    Groups are counted before they meet the pages, so a payload that many
    pages share is one row on that side and its pages may be split over tasks.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    sized = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )
    groups = (
        sized.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("_keep"), F.max_by("url", "page_id").alias("_url"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    joined = sized.join(groups, ["payload_digest", "payload_bytes"], "left")
    copy = F.col("_keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keep"))
    refers = F.when(copy, F.col("_keep")).alias("refers_to"), F.when(copy, F.col("_url")).alias("refers_url")
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", *refers)


def _uri(url: str) -> str:
    """``url`` with control characters, spaces and characters beyond ASCII quoted, and nothing else."""
    return quote(url, safe="".join(map(chr, range(0x21, 0x7F))))


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, place: str = "", refers_url: str | None = None
) -> bytes:
    """One compressed WARC record, named by its place; a revisit carries headers only."""
    body = _HTTP if refers_to is not None else _HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}"]
    lines.append(f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>")
    if page_id is not None:
        lines.append(f"Page-Id: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + _uri(url))
        if _uri(url) != url:
            lines.append("Page-Url: " + quote(url, safe=""))
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"Refers-To-Page: {refers_to}")
        if refers_url is not None:
            lines += ["WARC-Refers-To-Target-URI: " + _uri(refers_url), f"WARC-Refers-To-Date: {date}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + body + b"\r\n\r\n", compresslevel=3, mtime=0)


def parse(data: bytes) -> dict:
    """Fields of one compressed record; raises ValueError where a stored payload does not match its digest."""
    head, _, rest = zlib.decompress(data, wbits=31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    page, refers, url = fields.get("Page-Id"), fields.get("Refers-To-Page"), fields.get("WARC-Target-URI")
    payload = body.partition(b"\r\n\r\n")[2] if refers is None else None
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    if len(rest) != len(body) + 4 or payload is not None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": None if page is None else int(page),
        "url": unquote(fields["Page-Url"]) if "Page-Url" in fields else url,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
        "payload": payload,
    }


def _writer(folder: str, date: str):
    def write(batches):
        number, out, at = TaskContext.get().partitionId(), None, 0
        store, base = open_store(folder)
        name = f"part-{number:06d}-{uuid.uuid4().hex}.warc.gz"
        names = ("page_id", "url", "payload", "payload_digest", "refers_to", "refers_url")
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                rows = []
                for page_id, url, payload, digest, refers_to, refers_url in zip(*(batch.column(c).to_pylist() for c in names)):
                    data = record(page_id, url, payload.encode(), digest, refers_to, date, f"{name}/{at}", refers_url)
                    out.write(data)
                    rows.append((number, name, at, len(data), url, digest, page_id, "response" if refers_to is None else "revisit"))
                    at += len(data)
                kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return write


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """Write all pages; returns the folder and the index, a committed table."""
    ship(pages.sparkSession)
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    return folder, stage(with_types(pages, least).mapInArrow(_writer(folder, date), INDEX))


def ranges(index: DataFrame, span: int = SPAN, gap: int = GAP) -> DataFrame:
    """Selected records joined into byte ranges: one row per range with its records in order."""
    order = Window.partitionBy("file").orderBy("offset")
    after = F.lag(F.col("offset") + F.col("length")).over(order)
    runs = index.select("file", "offset", "length").withColumn("_new", (F.col("offset") - after > gap).cast("int"))
    runs = runs.withColumn("_run", F.coalesce(F.sum("_new").over(order), F.lit(0)))
    return runs.groupBy("file", "_run", F.floor(F.col("offset") / span).alias("_part")).agg(
        F.min("offset").alias("begin"),
        F.max(F.col("offset") + F.col("length")).alias("end"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def _reader(folder: str, keep_payload: bool):
    def read(batches):
        store, base = open_store(folder)
        names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * keep_payload
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * keep_payload
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    data = source.read_at(row["end"] - row["begin"], row["begin"])
                found = []
                for r in row["records"]:
                    begin = r["offset"] - row["begin"]
                    found.append(parse(data[begin : begin + r["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], kind) for n, kind in zip(names, kinds)], names=names)

    return read


def read_archives(folder: str, selected: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records that index rows name; payloads of responses are checked against their digests."""
    ship(selected.sparkSession)
    schema = RECORD + (", payload binary" if keep_payload else "")
    size = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(partitions(selected.sparkSession), -(-size // TASK_BYTES))
    spread = ranges(selected).repartition(tasks, "file", "begin")
    return spread.drop("_run", "_part").mapInArrow(_reader(folder, keep_payload), schema)
