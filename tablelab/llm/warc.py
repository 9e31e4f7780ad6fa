"""WARC archives: a writer, and a reader that splits compressed files into byte ranges.

Every record is a gzip member of its own. The reader cuts files into ranges; a task looks for gzip magic in its
range, validates each candidate by decompressing and parsing the beginning of a WARC header, and owns the
records that start inside its range, reading on past the end of the range for the last one. Files are opened
by ``pyarrow.fs``, so local folders and object stores work alike; a member is decompressed as it is read.

Payloads that occur more than once are written once: the record with the largest page_id is the response, the
others are revisits that refer to it. The table of such payloads has no row for a payload that is unique.

Defined cases: null html is an empty payload (and takes part in the comparison like any other); rows with a
null page_id are responses without a number and nothing refers to them; equal rows of one page_id are all responses if it is
the largest; null url gives a record without a target address.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab import session

MAGIC = b"\x1f\x8b\x08"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_HEAD_BYTES = 4096
_ID = re.compile(rb"<urn:page-record:(-?\d+|none)>")


def payload_of(html: str = "html") -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def repeated_payloads(pages: DataFrame) -> DataFrame:
    """sha1 and winner (largest page_id) of payloads that more than one row has."""
    sums = pages.select(F.unhex(F.sha1(payload_of())).alias("sha1"), "page_id").groupBy("sha1").agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
    return session.stage(sums.where("n > 1 and winner is not null").select("sha1", "winner"), "payloads")


def _member(page_id, url, digest: str, payload: bytes, winner) -> bytes:
    """One record as a gzip member."""
    revisit = winner is not None and page_id is not None and winner != page_id
    name = "none" if page_id is None else str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page-record:{name}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page-record:{winner}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    head.append(f"Content-Length: {len(body)}")
    data = "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the stored list of files: path, size, records.

    A task that runs twice writes two files, of which only the one of the attempt that counted is listed.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload_of().alias("payload"), F.unhex(F.sha1(payload_of())).alias("sha1"))
    rows = rows.join(repeated_payloads(pages), "sha1", "left").select("page_id", "url", "payload", "sha1", "winner")

    def run(batches) -> Iterator[pd.DataFrame]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        name = f"{base}/part-{context.partitionId():05d}-{uuid.uuid4().hex[:12]}.warc.gz"
        size = n = 0
        out = None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                page_id, url, payload, sha1, winner = row
                if out is None:
                    out = fs.open_output_stream(name, compression=None)
                member = _member(page_id, url, base64.b32encode(sha1).decode(), payload, winner)
                out.write(member)
                size, n = size + len(member), n + 1
        if out is not None:
            out.close()
            import pyarrow as pa

            yield pa.RecordBatch.from_pydict({"path": [name], "size": [size], "records": [n]}, pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())]))

    return session.stage(rows.mapInArrow(run, "path string, size long, records long"), "archives")


def _head_of(data: bytes) -> bytes:
    """Beginning of the content of a gzip member that starts ``data``, empty if it is none."""
    try:
        return zlib.decompressobj(31).decompress(data, _HEAD_BYTES)
    except zlib.error:
        return b""


def _is_record(data: bytes) -> bool:
    head = _head_of(data)
    return head.startswith(b"WARC/1.") and b"\nWARC-Type:" in head


def _parse(data: bytes) -> tuple:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    number = lambda key: None if (m := _ID.search(fields.get(key, b""))) is None or m[1] == b"none" else int(m[1])
    body = body[: int(fields[b"Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = fields[b"WARC-Type"].decode()
    stated = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != stated:
            raise ValueError(f"payload of record {fields[b'WARC-Record-ID']!r} does not match its digest")
        size = len(payload)
    else:
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    url = fields.get(b"WARC-Target-URI")
    return number(b"WARC-Record-ID"), url and url.decode("utf-8", "replace"), size, stated, kind, number(b"WARC-Refers-To"), payload


def records_in(file, size: int, start: int, stop: int, step: int = 1 << 16) -> Iterator[tuple]:
    """Records whose first byte lies in [start, stop) of an open file."""
    at = start
    while at < stop:
        # a magic may lie across the end of the range: its first byte decides
        window = file.read_at(min(stop - at + len(MAGIC) - 1, step + len(MAGIC) - 1), at)
        spot = window.find(MAGIC)
        if spot < 0:
            at += max(len(window) - len(MAGIC) + 1, 1)
            continue
        at += spot
        if at >= stop:
            return
        if not _is_record(file.read_at(min(2 * _HEAD_BYTES, size - at), at)):
            at += 1
            continue
        unpack, parts, near = zlib.decompressobj(31), [], at
        while not unpack.eof and near < size:
            piece = file.read_at(min(step, size - near), near)
            near += len(piece)
            parts.append(unpack.decompress(piece))
        if not unpack.eof:
            raise ValueError(f"the record at byte {at} is cut off")
        yield _parse(b"".join(parts))
        at = near - len(unpack.unused_data)


def read(archives: DataFrame, range_bytes: int = 4 << 20, folder: str = "", payload: bool = True) -> DataFrame:
    """Records of archives (path, size): columns as in ``RECORDS``, payload only on request."""
    ranges = archives.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    spread = max(archives.sparkSession.sparkContext.defaultParallelism, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = ranges.repartition(spread, "path", "start")
    schema = RECORDS if payload else RECORDS.removesuffix(", payload binary")

    def run(frames) -> Iterator[pd.DataFrame]:
        fs, _ = pafs.FileSystem.from_uri(folder) if folder else (pafs.LocalFileSystem(), "")
        names = [c.split()[0] for c in schema.split(", ")]
        for frame in frames:
            for path, size, start in frame.itertuples(index=False):
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for row in records_in(file, size, start, min(start + range_bytes, size)):
                        rows.append(row[: len(names)])
                        held += len(row[6]) if payload else 0
                        if held > 16 << 20 or len(rows) >= 5_000:
                            yield _frame(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    return ranges.mapInPandas(run, schema)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})
