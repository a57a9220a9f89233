"""Repeated byte strings against a plain scan of all windows."""

import hashlib
import tracemalloc

import pyarrow as pa
import pytest

from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, odd_rows, with_clashes
from terratally.llm import substrings
from terratally.llm.common import slices

PERIODIC = [
    (100, "abc" * 300),
    (101, "xyz" + "abc" * 200 + "é" * 120),
    (102, "q" * 99),
    (103, "q" * 100),
    (104, "q" * 101),
    (105, "é" * 130 + "tail"),
]


def plain(rows, length=100):
    """(id, bytes, removed, runs, hash of what is kept) per row; equal rows are one document."""
    done, out = {}, {}
    seen = set()
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for key, text in order:
        data = (text or "").encode()
        mark = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                mark[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, m in zip(data, mark, strict=True) if not m)
        runs = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        done[key, text] = (key, len(data), sum(mark), runs, hashlib.sha256(kept).hexdigest())
    out = sorted((done[row] for row in rows), key=str)
    return out


def result(frame):
    return sorted((tuple(r)[:5] for r in frame.collect()), key=str)


@pytest.mark.parametrize("path", ["filter", "join", "frequent"])
def test_table_and_periodic_texts(spark, monkeypatch, path):
    if path == "join":
        monkeypatch.setattr(substrings, "FILTER_SEEDS", -1)
    if path == "frequent":
        monkeypatch.setattr(substrings, "FREQUENT", 2)
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").where("doc_id < 120").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(i + 1000, t) for i, t in PERIODIC]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(substrings.deduplicate(frame)) == plain(rows)


@pytest.mark.parametrize("filter_seeds", [substrings.FILTER_SEEDS, -1])
def test_hot_passages_never_meet_in_one_group(spark, monkeypatch, filter_seeds):
    """What stands around a shared passage differs by document, so no side of its edges is rare."""
    monkeypatch.setattr(substrings, "FREQUENT", 5)
    monkeypatch.setattr(substrings, "GROUP_ROWS", 1)
    monkeypatch.setattr(substrings, "FILTER_SEEDS", filter_seeds)
    passage = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(4))

    def own(i):
        return "".join(hashlib.sha256(f"{i} {k}".encode()).hexdigest() for k in range(3))

    rows = [(i, own(i) + passage + own(-i)) for i in range(1, 41)] + [(None, "z" + passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(substrings.deduplicate(frame)) == plain(rows)
    texts = substrings._rows(frame, "text")
    found = substrings._suffixes(texts, substrings._repeated(texts, 100), 100)
    suffixes = found[0] if isinstance(found, tuple) else found
    held = suffixes.where("to IS NULL").groupBy("seed").count().agg({"count": "max"}).first()[0]
    assert (held or 0) <= 5


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] != 1]  # equal ids have no order of their own
    docs = with_clashes(odd_documents(spark)).where("doc_id IS NULL OR doc_id <> 1")
    assert result(substrings.deduplicate(docs)) == plain(rows)
    assert substrings.deduplicate(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_rows_come_out_alike(spark):
    docs = odd_documents(spark).where("doc_id = 1")
    found = result(substrings.deduplicate(docs))
    assert found.count(found[0]) == 2 or found.count(found[1]) == 2


def test_kept_bytes(spark):
    text = "0123456789" * 12 + "unique end"
    docs = spark.createDataFrame([(1, text), (2, "start " + text)], "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["kept"]) for r in substrings.deduplicate(docs).collect()}
    assert kept[2] == b"start "


def test_seeds_take_little_memory_at_a_time():
    """What a worker once took it keeps, so texts are worked on in small slices."""
    texts = pa.array(["".join(hashlib.sha256(f"{i} {k}".encode()).hexdigest() for k in range(32)) for i in range(2000)])
    tracemalloc.start()
    try:
        found = sum(len(substrings.seeds(part)[0]) for part in slices(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found > 2000 * 2048 / 50
    assert peak < 40 << 20
