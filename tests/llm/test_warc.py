"""Archives: exact round trips, valid gzip, random access through the index."""

import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from prosemill.llm import warc

PAGES = "page_id long, url string, html string"
LONG = "<p>" + "äöü ß " * 300 + "</p>"
ROWS = [
    (5, "http://a/", "x" * 100), (3, "http://b/\r\nWARC-Type: fake", "x" * 100), (9, None, "x" * 99),
    (8, "u", "x" * 99), (1, "u", None), (2, "u", ""), (7, "u", LONG), (6, "u", LONG), (6, "u", LONG),
    (None, "u", LONG), (10, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nabc\x00"),
    (11, "u", "b" * 3_000_000),
]


@pytest.fixture()
def pages(shared):
    rows = shared.createDataFrame(ROWS, PAGES)
    for name in ("payload", "first", "value", "room", "run", "place", "n", "payload_digest", "record_type", "Archive"):
        rows = rows.withColumn(name, F.lit(1))  # names that the operator uses itself
    return rows.repartition(2)


def expected():
    seen = {}
    for i, _, h in ROWS:
        if i is not None and len((h or "").encode()) >= 100:
            seen[h] = min(seen.get(h, i), i)
    out = []
    for i, _, h in ROWS:
        data = (h or "").encode()
        first = seen.get(h) if len(data) >= 100 else None
        copy = first is not None and first != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if copy else "response", first if copy else None))
    return sorted(out, key=str)


def test_round_trip(pages):
    rows = warc.round_trip(pages).collect()
    got = []
    for r in rows:
        payload = bytes(r.payload)
        if r.record_type == "response":
            assert (len(payload), hashlib.sha256(payload).hexdigest()) == (r.header_bytes, r.header_digest)
        else:
            assert payload == b""
        got.append((r.page_id, r.header_bytes, r.header_digest, r.record_type, r.refers_to))
    assert sorted(got, key=str) == expected()


def test_files_and_index(shared, pages, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    warc.write_monolithic(warc.payloads(pages), raw, records_per_file=4)
    warc.normalise(shared, raw, out)
    written = list((tmp_path / "raw").rglob("*.gz"))
    assert len(written) >= 3
    for f in written:
        inflater = zlib.decompressobj(31)
        inflater.decompress(f.read_bytes())
        assert inflater.eof and not inflater.unused_data  # one stream
    index = shared.read.parquet(out + "/index").collect()
    assert len(index) == len(ROWS)
    files = {f.parent.name.removeprefix("archive="): f for f in (tmp_path / "out/archives").rglob("*.txt")}
    before = sorted(gzip.decompress(f.read_bytes()) for f in written)
    after = sorted(gzip.decompress(files[a].read_bytes()) for a in files)
    assert before == after
    for row in index:
        data = files[row.archive].read_bytes()[row.offset : row.offset + row.length]
        record = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    some = shared.read.parquet(out + "/index").where("record = 1")
    assert warc.read_indexed(shared, out, some).count() == some.count() > 0


def test_files_are_bounded_in_bytes(shared, tmp_path):
    sizes = [10, 3000, 3000, 20_000, 10, 3000, 70_000, 3000, 3000, 90_000, 3000, 10] * 4
    rows = [(i, "u", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)]
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    df = shared.createDataFrame(rows, PAGES).repartition(2)
    warc.write_monolithic(warc.payloads(df), raw, records_per_file=30, file_bytes=40_000)
    texts = [gzip.decompress(f.read_bytes()) for f in (tmp_path / "raw").rglob("*.gz")]
    counts = [t.count(b"WARC/1.1\r\n") for t in texts]
    assert sum(counts) == len(rows) and max(counts) <= 30
    assert all(len(t) <= 40_000 or n == 1 for t, n in zip(texts, counts))
    assert any(n > 1 for n in counts)
    warc.normalise(shared, raw, out)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_all(shared, out).collect()}
    assert got == {i: html for i, _, html in rows}
    assert shared.read.parquet(out + "/index").select("archive", "record").distinct().count() == len(rows)


def test_no_pages(shared, pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_archive_is_an_error():
    packed = gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")
    with pytest.raises(ValueError):
        list(warc.inflate_records(memoryview(packed)))
