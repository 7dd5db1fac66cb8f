"""WARC archives, index first.

Writing: every task appends its records to one archive file in a shared folder, each record a
gzip member of its own, and returns one index row per record (file, offset, length, URL,
digest). The index is a written table; a file no index row names is the rest of a lost attempt.
Reading: the selected index rows are sorted by file and offset, neighbouring byte ranges are
read in one request, and the records are parsed from the bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewharf.llm.base import Scratch

#: Payloads at least this long are stored once.
MIN_REVISIT_BYTES = 0
#: Ranges closer than this are read together, up to the second number.
GAP_BYTES, READ_BYTES = 64_000, 8_000_000
#: Archive bytes a reading task gets; the index rows alone would tell too little about its work.
TASK_BYTES = 64_000_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX_SCHEMA = "file string, offset long, length long, url string, digest string, page_id long, record_type string, refers_to long"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _parsed_id(value: str | None) -> int | None:
    number = (value or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def _field(value: str) -> str:
    """A header value; control characters cannot end the line."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _unfield(value: str) -> str:
    return re.sub(r"%([01][0-9A-F]|7F|25)", lambda m: chr(int(m[1], 16)), value)


def record(page_id, url, payload: bytes, payload_digest: str, record_type: str, refers_to) -> bytes:
    """One uncompressed record. A revisit holds the HTTP head only and names its response."""
    block = HTTP_HEAD + (payload if record_type == "response" else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_field(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-X-Payload-Length: {len(payload)}",
    ]
    if record_type == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one uncompressed record; raises when it is damaged."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record of another length than its header says")
    payload = block.partition(b"\r\n\r\n")[2]
    name = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and digest(payload) != name:
        raise ValueError("payload does not match its digest")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": _parsed_id(fields["WARC-Record-ID"]), "url": None if url is None else _unfield(url),
        "payload_bytes": int(fields["WARC-X-Payload-Length"]), "payload_digest": name,
        "record_type": fields["WARC-Type"], "refers_to": _parsed_id(fields.get("WARC-Refers-To")),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The shared folder as tasks see it, by its URI (file, hdfs, s3, ...)."""
    if "://" not in folder and not folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), folder
    return pa.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        out, name, at = None, f"{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            rows = {c: [] for c in ("file", "offset", "length", "url", "digest", "page_id", "record_type", "refers_to")}
            for page_id, url, html, sha, kind, refers in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (html or "").encode()
                squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = squeeze.compress(record(page_id, url, payload, base64.b32encode(bytes.fromhex(sha)).decode(), kind, refers)) + squeeze.flush()
                if out is None:
                    fs.create_dir(root)
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                out.write(data)
                for c, v in zip(rows, (name, at, len(data), url, base64.b32encode(bytes.fromhex(sha)).decode(), page_id, kind, refers)):
                    rows[c].append(v)
                at += len(data)
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))
        if out is not None:
            out.close()

    return write


def _plan(pages: DataFrame, scratch: Scratch, min_bytes: int) -> DataFrame:
    """``pages`` plus sha, record_type, refers_to. Of equal payloads the largest page_id is the
    response. The first page ids per digest are one aggregate; digests that occur once need no
    look-up, so only the table of repeated digests is joined back."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(html.cast("binary")).alias("sha"))
    again = (
        pages.select(F.sha1(html.cast("binary")).alias("_tw_sha"), F.col("page_id").cast("long").alias("page_id"), F.octet_length(html).alias("n"))
        .where(F.col("n") >= min_bytes)
        .groupBy("_tw_sha").agg(F.max("page_id").alias("_tw_first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    again = scratch.cut(again, "repeats")
    joined = keyed.join(again, keyed.sha == again._tw_sha, "left")
    later = F.col("_tw_sha").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_tw_first"))
    return joined.select(
        "page_id", "url", "html", "sha", F.when(later, "revisit").otherwise("response").alias("record_type"),
        F.when(later, F.col("_tw_first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, scratch: Scratch, min_bytes: int = MIN_REVISIT_BYTES) -> tuple[str, DataFrame]:
    """(folder, index) of the archives of all ``pages`` (page_id, url, html).

    A null html is an empty payload, a null url has no URI field, a null page_id an empty record
    id. Rows that tie for the largest page_id are all responses. No rows give an empty index.
    """
    folder = scratch.folder("archives")
    index = _plan(pages, scratch, min_bytes).mapInArrow(_writer(folder), INDEX_SCHEMA)
    return folder, scratch.cut(index, "index")


def ranges(rows: Iterator[tuple], gap: int, most: int) -> Iterator[list[tuple]]:
    """Sorted (file, offset, length) rows in runs that one request reads."""
    run: list[tuple] = []
    for row in rows:
        if run:
            file, start = run[0][0], run[0][1]
            end = run[-1][1] + run[-1][2]
            if row[0] != file or row[1] - end > gap or row[1] + row[2] - start > most:
                yield run
                run = []
        run.append(row)
    if run:
        yield run


def _reader(folder: str, gap: int, most: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        opened, handle = None, None
        for run in ranges(rows, gap, most):
            if opened != run[0][0]:
                if handle:
                    handle.close()
                opened, handle = run[0][0], fs.open_input_file(f"{root}/{run[0][0]}")
            start = run[0][1]
            data = handle.read_at(run[-1][1] + run[-1][2] - start, start)
            found = [parse(zlib.decompress(data[o - start : o - start + n], 31)) for _, o, n in run]
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in zip(names, types)], names=names)
        if handle:
            handle.close()

    return read


def read_records(folder: str, index: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """The records of the given index rows. Archives are cut into stretches of ``most`` bytes,
    each read by one task in the order of offsets, so one large archive is read by many.

    The number of tasks follows the archive bytes to read: left to itself, adaptive execution
    would merge tasks by the size of the index, which is a small part of what they read."""
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = index.select("file", "offset", "length").repartition(tasks, "file", F.expr(f"offset div {most}L"))
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(_reader(folder, gap, most), RECORD_SCHEMA)


def report(pages: DataFrame) -> DataFrame:
    """One row per page, from the records read back."""
    folder, index = write_archives(pages.select("page_id", "url", "html"), Scratch(pages.sparkSession, "warc"))
    return read_records(folder, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The digest in base32: five bits at a time of the SHA-1.
SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b, sha1(coalesce(html, '')) as h from pages),
d as (select page_id, octet_length(b) as payload_bytes, h, max(page_id) over (partition by h) as first,
    array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (cast('0x' || substr(h, 1 + 10 * (i // 8), 10) as bigint) >> (35 - 5 * (i % 8))) % 32, 1)), '') as payload_digest
    from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to from d
"""
