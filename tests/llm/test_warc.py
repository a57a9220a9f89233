"""Archives written, normalised and read back."""

import base64
import gzip
import hashlib
import json
import zlib
from pathlib import Path

from tests.conftest import TESTDATA
from terratally.llm import warc
from terratally.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, record string, sha string, keeper string"


def expected(rows):
    digest = lambda html: base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    largest = {}
    for key, html in rows:
        d = digest(html)
        largest[d] = max((x for x in (largest.get(d), key) if x is not None), default=None)
    out = []
    for key, html in rows:
        keeper = largest[digest(html)]
        revisit = keeper is not None and key != keeper
        out.append((key, len((html or "").encode()), digest(html), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


def test_table(spark):
    pages = spark.read.parquet(f"{TESTDATA}/pages.parquet")
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    assert sorted((tuple(r) for r in QUERIES["op9_warc"](spark, TESTDATA).collect()), key=str) == expected(rows)


def test_odd_pages(spark, tmp_path):
    rows = [
        (1, "http://a/b c\r\nX: 1", "<p>same</p>", "x", "x", "x"),
        (2, None, "<p>same</p>", "x", "x", "x"),
        (2, None, "<p>same</p>", "x", "x", "x"),
        (None, "u", "<p>same</p>", "x", "x", "x"),
        (3, "u", None, "x", "x", "x"),
        (4, "ü", "", "x", "x", "x"),
        (5, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\x00💡" * 3, "x", "x", "x"),
        (6, "u", "long " * 300_000, "x", "x", "x"),
    ]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    found = warc.round_trip(pages, f"file://{tmp_path}/a").collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=str)
    assert got == expected([(r[0], r[2]) for r in rows])
    urls = {r["page_id"]: r["url"] for r in found}
    assert urls[1] == rows[0][1] and urls[4] == "ü"
    bodies = {r["page_id"]: bytes(r["payload"]) for r in found if r["record_type"] == "response"}
    assert bodies[5] == rows[6][2].encode() and bodies[6] == rows[7][2].encode()


def test_members_and_index(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>", "", "", "") for i in range(50)], PAGES).coalesce(1)
    warc.round_trip(pages, f"file://{tmp_path}/b").collect()
    (whole,) = Path(tmp_path, "b/monolithic").glob("*.gz")
    inflater = zlib.decompressobj(31)
    inflater.decompress(whole.read_bytes())
    assert inflater.eof and not inflater.unused_data  # one stream
    (archive,) = Path(tmp_path, "b/normal").glob("*.warc.gz")
    (index,) = Path(tmp_path, "b/normal").glob("*.jsonl")
    data, entries = archive.read_bytes(), [json.loads(line) for line in index.read_text().splitlines()]
    assert len(entries) == 50 and sum(e["length"] for e in entries) == len(data)
    for entry in entries:
        record = gzip.decompress(data[entry["offset"] : entry["offset"] + entry["length"]])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"X-Page-Id: {entry['page_id']}\r\n".encode() in record


def test_least_bytes_and_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab", "", "", ""), (2, "u", "ab", "", "", "")], PAGES)
    kinds = {r["record_type"] for r in warc.round_trip(pages, f"file://{tmp_path}/c", least_bytes=3).collect()}
    assert kinds == {"response"}
    assert warc.round_trip(pages.limit(0), f"file://{tmp_path}/d").collect() == []
