"""Near-duplicate components against a plain all-pairs search."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from tests.llm.tables import SCHEMA, components, odd_documents, odd_rows, with_clashes, words
from terratally.llm import jaccard
from terratally.llm.components import components as connected


def shingles(text, size=5):
    found = [w.lower() for w in words(text)]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def expected(rows):
    """(id, text) -> component, with equal (id, text) as one node."""
    sets = {i: shingles(text) for i, (_, text) in enumerate(rows)}

    def linked(a, b):
        common = len(sets[a] & sets[b])
        union = len(sets[a]) + len(sets[b]) - common
        return bool(sets[a]) and bool(sets[b]) and 100 * common >= 75 * union

    roots = components(range(len(rows)), linked)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[roots[i]] = min(key, least.get(roots[i], key))
    return Counter((rows[i][0], len(sets[i]), least.get(roots[i])) for i in range(len(rows)))


def near_copies(seed=3, groups=25):
    """Groups of near copies at all distances around the threshold, sharing a common passage."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = draw.choices(vocabulary, k=40)
    rows, key = [], 0
    for _ in range(groups):
        base = draw.choices(vocabulary, k=draw.randint(5, 120)) + passage * draw.randint(0, 1)
        for _ in range(draw.randint(1, 12)):
            text = list(base)
            for _ in range(draw.randint(0, 6)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append((key, " ".join(text)))
            key += 1
    draw.shuffle(rows)
    return rows


def result(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("leaf", [2, 8])
def test_near_copies(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.join_components(docs)) == expected(rows)


def test_table(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").where("doc_id < 250")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(jaccard.join_components(docs)) == expected(rows)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    docs = with_clashes(odd_documents(spark))
    assert result(jaccard.join_components(docs)) == expected(rows)


def test_one_of_each(spark):
    docs = with_clashes(odd_documents(spark))
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    found = Counter((r["doc_id"], (r["text"] or "")[:9]) for r in kept.collect())
    assert found == Counter(
        {
            (1, "The quick"): 1,  # twice, in capitals without id, and near copy 5
            (1, "something"): 1,
            (2, ""): 1,
            (3, ""): 1,
            (4, " \t\n\r\x0b\x0c "): 1,
            (None, ""): 1,
            (6, "one two"): 1,
            (8, "word0 and"): 1,
            (-7, "Ünï cödé "): 1,
        }
    )
    assert (None, "THE QUICK") not in found and (7, "ONE  two") not in found


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_linked_sets_share_neighbours(percent):
    draw = np.random.default_rng(percent)
    checked = 0
    for _ in range(4000):
        x = draw.choice(2**62, draw.integers(1, 60), replace=False).astype(np.uint64)
        kept = draw.permutation(x)[draw.integers(0, len(x) // 3 + 1) :]
        new = draw.choice(2**62, draw.integers(0, len(x) // 3 + 1), replace=False).astype(np.uint64)
        y = np.union1d(kept, new)
        x = np.sort(x)
        common = len(np.intersect1d(x, y))
        if 100 * common < percent * (len(x) + len(y) - common):
            continue
        checked += 1
        pairs, others = (jaccard._neighbours(v, np.zeros(len(v), np.int64)) for v in (x, y))
        assert len(np.setdiff1d(pairs, others)) <= jaccard.neighbours_lost(len(x), percent)
    assert checked > 100


def test_neighbours_stay_within_their_text():
    values = np.array([1, 2, 3, 7, 1, 2, 3], dtype=np.uint64)
    pairs = jaccard._neighbours(values, np.array([0, 0, 0, 2, 5, 5, 5]))
    assert list(pairs[:3]) == list(pairs[4:]) and len(set(pairs)) == 4
    assert len(jaccard._neighbours(values[:0], np.zeros(0, np.int64))) == 0


def test_regions_of_the_same_members_are_one(spark):
    draw = np.random.default_rng(5)
    base, other = (np.sort(draw.choice(2**62, 80, replace=False)) for _ in range(2))
    near = np.sort(np.append(base[:-1], 2**62))
    alike = np.sort(np.append(other[:-2], base[[3, 50]]))  # some shingles in common, no neighbours
    rows = [(i, 80, [int(v) for v in values]) for i, values in enumerate((base, near, alike))]
    nodes = spark.createDataFrame(rows, "node long, n long, shingles array<long>")
    regions = jaccard._first_regions(nodes, 75).collect()
    assert sorted(r["node"] for r in regions) == [0, 1]
    assert len({r["region"] for r in regions}) == 1 and regions[0]["weight"] > 1
    assert jaccard._first_regions(nodes, 50).where("node < 2").count() >= 2


def test_blocks_of_a_cell_meet_once_each(spark, monkeypatch):
    """Sets move once per block of the other side; with pairs as rows it would be once per set."""
    monkeypatch.setattr(jaccard, "BLOCK", 2000)
    rows = spark.range(200).selectExpr("id % 2 AS cell", "id AS node", "100L AS n", "id AS root")
    probes = rows.where("node < 60")
    dealt = jaccard._dealt(probes, rows).collect()
    met = Counter()
    for block in {(r["cell"], r["p"], r["m"]) for r in dealt}:
        sides = [[r["node"] for r in dealt if (r["cell"], r["p"], r["m"]) == block and r["probe"] == x] for x in (True, False)]
        met.update((a, b) for a in sides[0] for b in sides[1])
    assert met == Counter((a, b) for a in range(60) for b in range(200) if a % 2 == b % 2)
    assert len(dealt) < len(met) / 2


@pytest.mark.parametrize("block", [1500, 1 << 16])
def test_group_of_alike_documents_without_a_centre(spark, monkeypatch, block):
    """Near copies of a text that is not there: some are linked, others alike but not alike enough."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "STEP", 1 << 12 if block < 1 << 16 else 1 << 20)
    draw = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for key in range(90):
        text = list(base)
        for _ in range(draw.randint(2, 5)):
            text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
        rows.append((key, " ".join(text)))
    wanted = expected(rows)
    assert 5 < len({component for _, _, component in wanted}) < 85
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.join_components(docs)) == wanted


def test_links_join_what_is_joined_already(spark):
    schema = "a long, b long"
    roots = jaccard._joined(None, spark.createDataFrame([(1, 2), (5, 6), (8, 9)], schema))
    roots = jaccard._joined(roots, spark.createDataFrame([(2, 6), (6, 1), (7, 9), (20, 21), (2, 1)], schema))
    roots = jaccard._joined(roots, spark.createDataFrame([(20, 21)], schema))
    found = {r["node"]: r["root"] for r in roots.collect()}
    assert found == {1: 1, 2: 1, 5: 1, 6: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jaccard.join_components(docs).collect() == []
    assert jaccard.one_of_each(docs).columns == docs.columns


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (None, 3)], "a long, b long")
    roots = {r["node"]: r["root"] for r in connected(edges).collect()}
    assert roots == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}
    assert connected(edges.where(F.lit(False))).collect() == []
