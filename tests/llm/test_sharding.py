"""Shards against a plain walk, and what appended shards take over."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import connect, differences, duckdb_result, spark_result
from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, odd_documents, odd_rows, with_clashes
from terratally.llm import sharding
from terratally.llm.common import mix

IDS = st.integers(-(2**63), 2**63 - 1)


def walk(key, shards):
    """One id at a time in Python's whole numbers."""
    state = int(mix(np.array([key], dtype=np.int64).view(np.uint64))[0])
    place, drawn = 0, 0
    while drawn < shards:
        place = drawn
        state = (state * 2862933555777941757 + 1) % 2**64
        drawn = int((place + 1) * (float(2**31) / float((state >> 33) + 1)))
    return place


def plain(rows, shards=16):
    measured = [
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows
    ]
    members, out = defaultdict(list), []
    for row in measured:
        members[walk(row[0] or 0, shards)].append(row)
    for shard, inside in members.items():
        inside.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        out += [(*r, "key", shard, i, walk(r[0] or 0, shards + 1)) for i, r in enumerate(inside)]
    return Counter(out)


@settings(max_examples=100, deadline=None)
@given(st.lists(IDS, max_size=40), st.integers(1, 200))
def test_jumps_are_those_of_the_walk(ids, shards):
    found = sharding.jump(np.array(ids, dtype=np.int64), shards)
    assert found.tolist() == [walk(key, shards) for key in ids]


@pytest.mark.parametrize("shards", [1, 2, 16, 100])
def test_appended_shards_alone_take_rows(shards):
    ids = np.arange(200_000)
    now, then = sharding.jump(ids, shards), sharding.jump(ids, shards + 1)
    moved = now != then
    assert np.all(then[moved] == shards)
    assert abs(moved.mean() - 1 / (shards + 1)) < 0.01
    sizes = np.bincount(now, minlength=shards)
    assert sizes.min() > 0.85 * len(ids) / shards and sizes.max() < 1.15 * len(ids) / shards


def test_no_shard():
    with pytest.raises(ValueError):
        sharding.jump(np.array([1]), 0)


def test_table(spark):
    found = spark_result(sharding.assign(spark.read.parquet(f"{TESTDATA}/documents.parquet")))
    assert differences(found, duckdb_result(connect(TESTDATA), sharding.SHARDING_SQL)) == ""


def test_odd_rows(spark):
    found = sharding.assign(with_clashes(odd_documents(spark))).collect()
    assert Counter(tuple(r) for r in found) == plain(odd_rows())
    assert sharding.assign(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_id(spark):
    """Thousands of rows of one id share a shard and still have a slot each."""
    rows = [(5 if i % 3 else i, f"t{i % 50}", None, None, None) for i in range(6000)]
    found = sharding.assign(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(tuple(r) for r in found) == plain(rows)


def test_written_shards(spark, tmp_path):
    documents = with_clashes(odd_documents(spark)).selectExpr("*", "'mine' AS shard")
    sharding.write_shards(documents, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(odd_rows())
    for row in back.collect():
        assert row["_shard"] == walk(row["doc_id"] or 0, 4) and row["shard"] == "mine"


def test_moving_rows(spark):
    documents = spark.createDataFrame([(i, "t", None, None, None) for i in range(900)], SCHEMA)
    found = {(r.doc_id, r.from_shard, r.to_shard) for r in sharding.moving(documents, 4, 2).collect()}
    pairs = [(i, walk(i, 4), walk(i, 6)) for i in range(900)]
    assert found == {p for p in pairs if p[1] != p[2]}
    assert all(new >= 4 for _, _, new in found)
