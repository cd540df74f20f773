"""WARC archives, index first.

Writing: each task appends its records, one gzip member each, to archives of
bounded size in a folder that all executors share, and yields an index row
(file, offset, length, url, digest) per record. The index is committed by
Spark's writer, so it names only files of tasks that succeeded; a file that a
lost or repeated task left behind is in no index.

Reading: index rows of the wanted records are sorted by file and offset and
coalesced into byte ranges, and each range is one read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_run_dir
from .common import slices, written

ARCHIVE_BYTES = 128 << 20
RANGE_BYTES, GAP_BYTES = 8 << 20, 64 << 10
#: Bytes of archives that one task reads, about.
TASK_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = ("file string, offset long, length long, url string, digest string, page_id string, record_type string")
_RECORD = ("page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
           "url string, payload binary")


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path there."""
    local = re.fullmatch(r"file:(?://)?(/.*)", uri)
    return fs.FileSystem.from_uri(local[1] if local else uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(text: str) -> str:
    """Header text without characters that would end the line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _id_line(text: str) -> str:
    """An id as header text; ``unquote`` gives it back."""
    return _line(text.replace("%", "%25"))


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """One uncompressed record; a revisit holds the HTTP head only."""
    digest = payload_digest(payload)
    block = _HTTP if revisit else _HTTP + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    head += [f"X-Page-ID: {_id_line(page_id)}"] if page_id is not None else []
    head += [f"WARC-Target-URI: {_line(url)}"] if url is not None else []
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"X-Refers-To-Page-ID: {_id_line(str(refers_to))}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of an uncompressed record; the digest of a response is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    fields |= {k: unquote(fields[k]) for k in ("X-Page-ID", "X-Refers-To-Page-ID") if k in fields}
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    return {"page_id": fields.get("X-Page-ID"), "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": fields.get("X-Refers-To-Page-ID"),
            "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload}


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", *, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` and returns the index.

    Of equal payloads of at least ``least_bytes`` bytes the smallest id is the
    response (all rows that share it are), the others revisit it; a payload all
    of whose ids are null is a response each time. A null html is an empty
    payload; a null url or id is left out of the record.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    shared = (rows.filter(F.octet_length("html") >= least_bytes).groupBy("sha")
              .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null"))
    # A table of its own, so that the join below is of two plain shuffles and a
    # payload that a third of the pages share is split.
    shared = written(shared.select("sha", "first"), "warc-shared")
    typed = rows.join(shared, "sha", "left").select(
        F.col("id").cast("string").alias("page_id"), "url", "html", F.col("first").cast("string").alias("refers_to"),
        (F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        sink, name, offset = None, "", 0
        for batch in slices(batches):
            out: dict[str, list] = {k.split()[0]: [] for k in _INDEX.split(", ")}
            for r in batch.to_pylist():
                if sink is None or offset >= archive_bytes:
                    if sink:
                        sink.close()
                    store.create_dir(path, recursive=True)
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    sink = store.open_output_stream(f"{path}/{name}", compression=None)
                payload = r["html"].encode()
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(record(r["page_id"], r["url"], payload, r["refers_to"], r["revisit"])) + packer.flush()
                sink.write(data)
                for k, v in (("file", name), ("offset", offset), ("length", len(data)), ("url", r["url"]),
                             ("digest", payload_digest(payload)), ("page_id", r["page_id"]),
                             ("record_type", "revisit" if r["revisit"] else "response")):
                    out[k].append(v)
                offset += len(data)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [(k, pa.int64() if k in ("offset", "length") else pa.string()) for k in out]))
        if sink:
            sink.close()

    return written(typed.mapInArrow(write, _INDEX), "warc-index")


def byte_ranges(index: DataFrame, *, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """(file, start, end, records): neighbours in a file read at once, up to
    about ``range_bytes`` and across gaps of at most ``gap_bytes``."""
    blocks = index.select("file", "offset", "length", F.floor(F.col("offset") / range_bytes).alias("block"))
    near = Window.partitionBy("file", "block").orderBy("offset")
    end = F.col("offset") + F.col("length")
    apart = F.coalesce((F.col("offset") - F.lag(end).over(near) > gap_bytes).cast("int"), F.lit(0))
    return (blocks.withColumn("apart", apart).withColumn("run", F.sum("apart").over(near)).groupBy("file", "block", "run")
            .agg(F.min("offset").alias("start"), F.max(end).alias("end"),
                 F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))
            .select("file", "start", "end", "records"))


def read_records(index: DataFrame, folder: str, *, payload: bool = True, **ranges) -> DataFrame:
    """The records that ``index`` names (filter it to select some), parsed; one
    row each. ``payload=False`` leaves that column null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        kinds = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]])
                           for f in _RECORD.split(", ")])
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{path}/{r['file']}") as source:
                    data = source.read_at(r["end"] - r["start"], r["start"])
                found = []
                for x in r["records"]:
                    at = x["offset"] - r["start"]
                    one = parse(zlib.decompress(data[at:at + x["length"]], 31))
                    found.append(one if payload else one | {"payload": None})
                yield pa.RecordBatch.from_pylist(found, schema=kinds)

    # An index row is small and its record is not: ranges are dealt by the bytes
    # they read, and neighbours stay together.
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    wanted = byte_ranges(index, **ranges).repartitionByRange(tasks, "file", "start").sortWithinPartitions("file", "start")
    return wanted.mapInArrow(read, _RECORD)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       *, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to archives and reads every record back: one row per row
    of ``pages`` with page_id, payload_bytes, payload_digest, record_type and
    refers_to, as the archives have them. Null and empty html are empty payloads,
    which are equal; long ones are written and digested whole; an id may be any text;
    each of several equal rows has its record, and if it has the smallest id each is
    the response; other columns, whatever their names, are ignored; an empty table
    writes no archive."""
    folder = f"{fresh_run_dir(pages.sparkSession, 'warc')}/archives"
    index = write_archives(pages, folder, id_col, url_col, html_col, least_bytes=least_bytes)
    kind = pages.schema[id_col].dataType
    return read_records(index, folder, payload=False).select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
