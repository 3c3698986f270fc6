import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from termloom.llm import zipwarc as zw

from .helpers import clash


def reader(data):
    return lambda at, n: data[at : at + n]


def archive(payloads):
    out = io.BytesIO()
    rows = [({"id": str(i)}, zw.warc_record("response", zw.record_name(i), "http://x/\r\ny", p, hashlib.sha1(p).hexdigest(), len(p), None)) for i, p in enumerate(payloads)]
    zw.write_zip(out, iter(rows))
    return out.getvalue()


def test_own_directory_reader_agrees_with_the_library():
    data = archive([b"abc", b"", b"x" * 100000])
    ours = zw.central_directory(len(data), reader(data))
    theirs = zipfile.ZipFile(io.BytesIO(data)).infolist()
    assert [(m.name, m.size, m.header, m.crc) for m in ours] == [(m.filename, m.file_size, m.header_offset, m.CRC) for m in theirs]
    records = [zw.parse_record(data[a : a + n]) for a, n in zw.record_ranges(len(data), reader(data))]
    assert [r["payload"] for r in records] == [b"abc", b"", b"x" * 100000] and records[0]["url"] == "http://x/%0D%0Ay"


def zip64(name, body):
    """A ZIP file that has its sizes and places in ZIP64 fields only."""
    big = 0xFFFFFFFF
    crc = zw.zlib.crc32(body)
    extra = struct.pack("<HHQQ", 1, 16, len(body), len(body))
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, crc, big, big, len(name), len(extra)) + name + extra
    cextra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, crc, big, big, len(name), len(cextra), 0, 0, 0, 0, big) + name + cextra
    start = len(local) + len(body)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, start + len(central), 1)
    comment = b"a comment PK\x05\x06 that looks like an end"
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, big, big, len(comment)) + comment
    return local + body + central + end64 + locator + end


def test_zip64_and_a_scan_without_an_index():
    whole = archive([b"one", b"two"])
    m = next(m for m in zw.central_directory(len(whole), reader(whole)) if m.name == zw.WARC)
    at = zw.data_offset(m, reader(whole))
    data = zip64(b"archive/other.warc.gz", whole[at : at + m.packed])
    found = zw.central_directory(len(data), reader(data))
    assert [(x.name, x.size, x.header) for x in found] == [("archive/other.warc.gz", m.packed, 0)]
    assert [zw.parse_record(data[a : a + n])["payload"] for a, n in zw.record_ranges(len(data), reader(data))] == [b"one", b"two"]


def test_uncompressed_members_are_read():
    payloads = [b"one", b"", b"\r\n\r\nWARC/1.1" * 9000]
    raw = [zw.warc_record("response", zw.record_name(i), None, p, hashlib.sha1(p).hexdigest(), len(p), None) for i, p in enumerate(payloads)]

    def stored(name, body):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            z.writestr("archive/", b"")
            z.writestr(name, body)
            z.writestr("pages/pages.jsonl", b"{}")
        return out.getvalue()

    data = stored("archive/data.warc", b"".join(raw))
    assert [zw.parse_record(data[a : a + n])["payload"] for a, n in zw.record_ranges(len(data), reader(data))] == payloads
    for bad in (stored("archive/data.warc", b"".join(raw)[:-5]), stored("archive/data.warc", b"no record"), stored("archive/data.arc", b"x")):
        with pytest.raises(zw.BadArchive):
            zw.record_ranges(len(bad), reader(bad))


def test_damage_is_noticed():
    data = archive([b"abc"])
    with pytest.raises(zw.BadArchive):
        zw.central_directory(100, reader(data[:100]))
    raw = zw.warc_record("response", zw.record_name(1), None, b"abc", hashlib.sha1(b"abd").hexdigest(), 3, None)
    with pytest.raises(zw.BadArchive):
        zw.parse_record(zw.gzip.compress(raw))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zw.WARC, b"x" * 1000)
    with pytest.raises(zw.BadArchive):
        zw.record_ranges(len(out.getvalue()), reader(out.getvalue()))


def test_round_trip(spark):
    big, small, wide = "b" * 1000, "s" * 999, "ü" * 500
    rows = [(1, "http://a", big), (2, None, big), (3, "http://c", small), (4, "http://d", small), (5, "e", None), (6, "f", ""), (7, "g", wide), (8, "h", wide), (None, "n", big), (9, "x", "\r\n\r\n" + "z" * 3000), (2, "again", big)]
    df = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = zw.round_trip(spark, df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = {p: (h or "").encode() for p, _, h in rows}[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(want), hashlib.sha1(want).hexdigest())
    kinds = sorted(str((r.page_id, r.record_type, r.refers_to)) for r in got)
    assert kinds == sorted(map(str, [(1, "revisit", 2), (2, "response", None), (2, "response", None), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (7, "revisit", 8), (8, "response", None), (None, "revisit", 2), (9, "response", None)]))
    assert zw.round_trip(spark, df.limit(0)).count() == 0


def test_payloads_come_back_whole(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("é"), F.repeat(F.col("id").cast("string"), 400)).alias("html"))
    paths = zw.write_archives(df, f"file://{tmp_path}/a")
    back = zw.read_archives(paths, payloads=True, slices=3)
    want = {r.page_id: r.html.encode() for r in df.collect()}
    assert {r.page_id: bytes(r.payload) for r in back.collect()} == want
