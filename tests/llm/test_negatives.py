"""Mined negatives against plain inner products of all rows."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import connect, differences, duckdb_result, spark_result
from tests.conftest import TESTDATA
from terratally.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, step=100):
    """The contract's words, row by row."""
    whole = []
    for key, vector, label in rows:
        if key is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if key % 7 == 0 else label
        whole.append((key, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for anchor in {r for r in whole if r[0] % step == 0}:
        scored = [(-sum(a * b for a, b in zip(anchor[2], r[2])), r[0], r[1]) for r in whole if r[0] != anchor[0]]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == anchor[1]][:5]:
            inside = [s for s in scored if s[2] != anchor[1] and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [
                (anchor[0], positive, rank, s[1], -p, -s[0]) for rank, s in enumerate(inside[:10], 1)
            ]
    return Counter(out)


def mined(spark, rows):
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA))
    return Counter(tuple(r) for r in found.collect())


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_scores_are_inner_products(data):
    width, top = data.draw(st.sampled_from([8, 16, 64])), data.draw(st.sampled_from([1, 256, 70_000]))
    rng = np.random.default_rng(data.draw(st.integers(0, 2**32)))
    anchors, rows = (rng.integers(-top, top, (n, width), endpoint=True) for n in (5, 23))
    bits, planes, groups = negatives.bit_planes(rows)
    assert bits.shape == (planes, groups, 23)
    assert np.array_equal(negatives.scores(negatives.subset_sums(anchors), bits), rows @ anchors.T)


def test_table(spark):
    found = spark_result(negatives.mine(spark.read.parquet(f"{TESTDATA}/embeddings.parquet")))
    assert differences(found, duckdb_result(connect(TESTDATA), negatives.MINING_SQL)) == ""
    assert len(found[1]) > 100


def test_many_cells(spark, monkeypatch):
    """Small blocks, stripes and bands, so that every anchor meets many cells; many ties."""
    for name, value in {"BLOCK": 50, "BLOCKS_A_STRIPE": 2, "ANCHORS_A_BAND": 3}.items():
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(3)
    rows = [
        (int(key), [float(x) / 4 for x in rng.integers(-2, 4, 12)], int(rng.choice([1, 1, 1, 2, 3, 9])))
        for key in range(1500)
    ]
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    inf, nan = math.inf, math.nan
    rows = [
        (0, [0.5, 0.25, -0.5], 9),
        (0, [0.5, 0.25, -0.5], 9),
        (0, [0.25, 0.25, -0.5], 1),
        (None, [0.5, 0.25, -0.5], 0),
        (1, [0.5, None, 0.5], 0),
        (2, [0.5, nan, 0.5], 0),
        (3, [0.5, inf, 0.5], 0),
        (4, None, 0),
        (5, [0.5, 0.5, -0.5], None),
        (6, [], 0),
        (7, [0.5, 0.5], 9),
        (8, [0.5, 0.5, -0.25, 0.125], 0),
        (9, [0.25, 0.25, -0.25], 2),
        (9, [0.25, 0.25, -0.25], 2),
        (10, [0.25, 0.125, -0.25], 3),
        (-100, [-0.5, -0.25, 0.5], 1),
        (-99, [-300.0, 4.0, 0.001], 1),
        (200, [0.0, 0.0, 0.0], 4),
        (11, [0.0, 0.0, 0.0], 4),
    ]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == Counter()
    assert mined(spark, [(100, [1.0], 1)]) == Counter()


def test_clashing_columns(spark):
    rows = spark.read.parquet(f"{TESTDATA}/embeddings.parquet").limit(300)
    names = ("anchor_row", "vector", "band", "stripe", "rank", "positives", "bits", "first_id")
    wider = rows.selectExpr("*", *(f"'x' AS {name}" for name in names))
    assert spark_result(negatives.mine(wider)) == spark_result(negatives.mine(rows))


def test_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(0, [3e20], 1), (1, [3e20], 1)])
