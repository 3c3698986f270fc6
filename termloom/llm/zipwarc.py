"""WARC records in ZIP-packaged archives, read by range without extraction.

Each partition writes one ZIP file with stored (uncompressed) members: the WARC file, whose
records are gzip members of their own, and an index of their places. The reader finds the end of
central directory (and its ZIP64 form), parses the central directory, resolves the members'
places from their local headers, reads the index, and then reads single records by range from
inside the archive. Files are written under a temporary name and renamed, so a task that is run
again replaces its archive as a whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import cut, fresh_dir, integer_id

WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
LEAST_REVISIT = 1000
#: Records that one row of the reading plan covers.
RANGE = 128
DATE = "2024-01-01T00:00:00Z"


class BadArchive(ValueError):
    pass


@dataclass
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int
    crc: int


class _Out:
    """What zipfile needs of a stream that can't seek."""

    def __init__(self, stream) -> None:
        self.stream, self.at = stream, 0

    def write(self, data) -> int:
        self.stream.write(data)
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        pass

    def seekable(self) -> bool:
        return False


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"^\w[\w+.-]*:/", uri):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return pafs.LocalFileSystem(), uri


def warc_record(kind: str, record_id: str, url: str | None, payload: bytes, digest: str, length: int, refers_to: str | None) -> bytes:
    """One WARC 1.1 record, not compressed; a revisit has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def record_name(page_id: int | None) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"


def write_zip(stream, records: Iterator[tuple[dict, bytes]]) -> int:
    """Write (index entry, record bytes) pairs as a ZIP archive; returns the number of records."""
    index, at = [], 0
    with zipfile.ZipFile(_Out(stream), "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(WARC), "w", force_zip64=True) as f:
            for entry, raw in records:
                data = gzip.compress(raw, 4, mtime=0)
                f.write(data)
                index.append(json.dumps(entry | {"offset": at, "length": len(data)}))
                at += len(data)
        with z.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            for line in index:
                f.write(line.encode() + b"\n")
    return len(index)


def central_directory(size: int, read) -> list[Member]:
    """Members of a ZIP file of size bytes; read(offset, length) gives bytes of it."""
    tail_at = max(0, size - 22 - 65535 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    # the end record is the last one whose comment reaches to the end of the file
    while at >= 0 and not (at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise BadArchive("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        (where,) = struct.unpack_from("<Q", tail, at - 12)
        end64 = read(where, 56)
        if end64[:4] != b"PK\x06\x06":
            raise BadArchive("bad ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    data, out, p = read(start, length), [], 0
    for _ in range(count):
        if data[p : p + 4] != b"PK\x01\x02":
            raise BadArchive("bad central directory")
        flags, method = struct.unpack_from("<HH", data, p + 8)
        crc, packed, plain, n, e, c = struct.unpack_from("<IIIHHH", data, p + 16)
        (header,) = struct.unpack_from("<I", data, p + 42)
        name = data[p + 46 : p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, q = data[p + 46 + n : p + 46 + n + e], 0
        while q + 4 <= len(extra):
            tag, m = struct.unpack_from("<HH", extra, q)
            if tag == 1:
                values = iter(struct.unpack_from(f"<{m // 8}Q", extra, q + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            q += 4 + m
        out.append(Member(name, method, plain, packed, header, crc))
        p += 46 + n + e + c
    return out


def data_offset(member: Member, read) -> int:
    """Where a stored member's bytes begin: after its local header."""
    if member.method != 0:
        raise BadArchive(f"{member.name} isn't stored")
    head = read(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise BadArchive(f"bad local header of {member.name}")
    n, e = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + e


def _plain_ranges(at: int, end: int, read) -> list[tuple[int, int]]:
    """(offset, length) of the records of an uncompressed WARC file, by their Content-Length."""
    out = []
    while at < end:
        head = b""
        while (stop := head.find(b"\r\n\r\n")) < 0:
            piece = read(at + len(head), min(1 << 12, end - at - len(head)))
            if not piece:
                raise BadArchive("a record isn't complete")
            head += piece
        length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head[:stop])
        if not head.startswith(b"WARC/") or not length:
            raise BadArchive("not a WARC record")
        out.append((at, stop + 4 + int(length[1]) + 4))
        at += out[-1][1]
        if at > end or read(at - 4, 4) != b"\r\n\r\n":
            raise BadArchive("a record isn't complete")
    return out


def record_ranges(size: int, read) -> list[tuple[int, int]]:
    """(offset in the ZIP file, length) of every WARC record, from the index, or by a scan without one."""
    members = {m.name: m for m in central_directory(size, read)}
    out = []
    for name, m in members.items():
        if not name.startswith("archive/") or name.endswith("/"):
            continue
        if not name.endswith((".warc.gz", ".warc")):
            raise BadArchive(f"{name} is no WARC file")
        base = data_offset(m, read)
        if name.endswith(".warc"):
            out += _plain_ranges(base, base + m.packed, read)
            continue
        if name == WARC and INDEX in members:
            i = members[INDEX]
            text = read(data_offset(i, read), i.packed)
            if zlib.crc32(text) != i.crc:
                raise BadArchive("the index is damaged")
            out += [(base + e["offset"], e["length"]) for e in map(json.loads, text.splitlines())]
            continue
        at, end = base, base + m.packed
        while at < end:
            d, used = zlib.decompressobj(31), at
            while not d.eof:
                piece = read(used, min(1 << 16, end - used))
                if not piece:
                    raise BadArchive("a record isn't complete")
                d.decompress(piece)
                used += len(piece)
            out.append((at, used - len(d.unused_data) - at))
            at += out[-1][1]
    return out


def parse_record(raw: bytes) -> dict:
    """Headers and payload facts of one record; the payload's digest is computed and compared."""
    data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise BadArchive("not a WARC record")
    h = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
    length = int(re.search(rb"(?i)^content-length: (\d+)", http, re.M)[1])
    if h["warc-type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise BadArchive(f"{h['warc-record-id']}: the payload doesn't match its digest")
    page = lambda s: int(m[1]) if (m := re.match(r"<urn:page:(-?\d+)>$", s or "")) else None
    return {"page_id": page(h["warc-record-id"]), "url": h.get("warc-target-uri"), "payload_bytes": length, "payload_digest": digest, "record_type": h["warc-type"], "refers_to": page(h.get("warc-refers-to")), "payload": payload if h["warc-type"] == "response" else None}


def _write(batches, base: str):
    fs, root = open_fs(base)
    fs.create_dir(root, recursive=True)
    part = TaskContext.get().partitionId()
    temporary, final = f"{root}/.{part:06d}-{uuid.uuid4().hex}", f"{root}/part-{part:06d}.wacz"

    def records():
        for batch in batches:
            for r in batch.to_pylist():
                payload = r["payload"].encode()
                kind = "revisit" if r["first"] is not None else "response"
                name = record_name(r["page_id"])
                yield {"id": name, "url": r["url"], "digest": r["digest"]}, warc_record(kind, name, r["url"], payload, r["digest"], len(payload), record_name(r["first"]) if kind == "revisit" else None)

    with fs.open_output_stream(temporary) as out:
        n = write_zip(out, records())
    if n:
        fs.move(temporary, final)
        yield pa.RecordBatch.from_arrays([pa.array([f"{base}/part-{part:06d}.wacz"]), pa.array([n], pa.int64())], names=["path", "records"])
    else:
        fs.delete_file(temporary)


def write_archives(df: DataFrame, base: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Write a record per row into ZIP archives under base; (path, records) of each archive.

    Of rows with equal payloads of at least least bytes, that with the largest id is a response
    (rows that repeat that id too), the others revisit it. A null payload is empty. Where all ids
    of equal payloads are null, all are responses. Ids must be integers. The
    rows are written when this is called.
    """
    pages = df.select(integer_id(df, id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    pages = pages.withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload").cast("long")})
    firsts = pages.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null").select("digest", "size", "top")
    rows = pages.join(firsts, ["digest", "size"], "left").select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("first"))
    return cut(rows.mapInArrow(lambda it: _write(it, base), "path string, records long"))


def _plan(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, p = open_fs(path)
            size = fs.get_file_info(p).size
            with fs.open_input_file(p) as f:
                ranges = record_ranges(size, lambda at, n, f=f: f.read_at(n, at))
            for i in range(0, len(ranges), RANGE):
                part = ranges[i : i + RANGE]
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([[a for a, _ in part]], pa.list_(pa.int64())), pa.array([[n for _, n in part]], pa.list_(pa.int64()))], names=["path", "offsets", "lengths"])


_FIELDS = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}


def _read(batches, payloads: bool):
    fields = _FIELDS | ({"payload": pa.binary()} if payloads else {})
    for batch in batches:
        for r in batch.to_pylist():
            fs, p = open_fs(r["path"])
            with fs.open_input_file(p) as f:
                rows = [parse_record(f.read_at(n, at)) for at, n in zip(r["offsets"], r["lengths"], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in fields.items()], names=list(fields))


def read_archives(paths: DataFrame, *, payloads: bool = False, slices: int | None = None) -> DataFrame:
    """One row for each record of the archives in the column path.

    (page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]); payload is
    null for revisits, ids are null where the record's name isn't a page's. Damaged archives raise.
    """
    plan = paths.select("path").repartition(slices or max(1, paths.sparkSession.sparkContext.defaultParallelism)).mapInArrow(_plan, "path string, offsets array<long>, lengths array<long>")
    plan = cut(plan)
    spread = plan.repartition(slices or max(1, paths.sparkSession.sparkContext.defaultParallelism))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    return spread.mapInArrow(lambda it: _read(it, payloads), schema)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder and read them back."""
    return read_archives(write_archives(pages, fresh_dir(spark, "warc")))
